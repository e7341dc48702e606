"""The operators as registered queries over their whole tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline.llm import alignment, language, pieces, rank_bpe, severity
from wickline.llm.decontaminate import leaks
from wickline.llm.licenses import RULES, SENTENCES, CREATIVE, scan_licenses
from wickline.llm.near_join import near_components
from wickline.llm.spans import table
from wickline.llm.suffix_dedup import remove_repeats
from wickline.llm.token_rollup import TokenRollup, bpe_counter, count_tokens, signed, word_count
from wickline.llm.topk import integer_vectors, top_k
from wickline.llm.warc import read_archives, write_archives
from wickline.llm.whitening import by_component, fit_whitening, grid_vectors, whiten
from wickline.session import fresh_path, settled


#: Where the vocabularies of public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op1_license_scan(spark, sf):
    """Every licence text or notice in every document."""
    return scan_licenses(table(spark, sf, "documents"))


_KNOWN = [*SENTENCES.items(), *((f"cc {c}", f"Licensed under {c}") for c in CREATIVE)]
_STEPS = [(i, name, len(ids), k, x) for i, (name, ids) in enumerate([*RULES, *((c.replace(" ", "-"), [f"cc {c}"]) for c in CREATIVE)])
          for k, x in enumerate(ids)]
_CUT = """list_transform(string_split(regexp_replace(lower(regexp_replace(regexp_replace(
    {}, '\\r?\\n[ \\t]*([a-z(])', ' \\1', 'g'), '[.!?;:]+[ \\t\\r\\n]+|[\\r\\n]+', chr(10), 'g')), '[^a-z0-9\\n]+', ' ', 'g'), chr(10)),
    lambda s: trim(s))"""
_UNWRAPPED = """regexp_replace(regexp_replace(text, '(^|\\n)[ \\t]*(?:#+|/{2,}|/?\\*+/?|--+|;+)[ \\t]*', '\\1', 'g'),
    '\\r?\\n[ \\t]*([^ \\t\\r\\n])', ' \\1', 'g')"""
OP1_SQL = f"""
    WITH known AS (
        SELECT sentence_id, list_filter({_CUT.format('sentence')}, lambda s: s <> '')[1] AS sentence
        FROM (VALUES {', '.join(f"({_literal(a)}, {_literal(b)})" for a, b in _KNOWN)}) AS v(sentence_id, sentence)),
    steps AS (
        SELECT * FROM (VALUES {', '.join(f"({i}, {_literal(name)}, {n}, {k}, {_literal(x)})" for i, name, n, k, x in _STEPS)})
        AS v(rule, licence, n, step, sentence_id)),
    said AS (
        SELECT doc_id, reading, unnest(parts) AS sentence, unnest(range(len(parts))) AS place
        FROM (SELECT doc_id, 0 AS reading, {_CUT.format('text')} AS parts FROM documents
              UNION ALL SELECT doc_id, 1, {_CUT.format(_UNWRAPPED)} FROM documents)),
    found AS (
        SELECT doc_id, reading, place, sentence_id, dense_rank() OVER (PARTITION BY doc_id, reading ORDER BY place) AS k
        FROM said JOIN known USING (sentence)),
    whole AS (
        SELECT doc_id, reading, rule, licence, n, k - step AS b, min(place) AS first_sentence
        FROM found JOIN steps USING (sentence_id) GROUP BY ALL HAVING count(DISTINCT step) = n),
    ordered AS (
        SELECT *, max(b + n) OVER (PARTITION BY doc_id, reading ORDER BY b, n DESC, rule
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS outer_end FROM whole),
    kept AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id, licence ORDER BY n DESC, reading) AS r
        FROM ordered WHERE outer_end IS NULL OR outer_end < b + n)
    SELECT doc_id, licence, rule, first_sentence::INT AS first_sentence, n AS n_sentences
    FROM kept JOIN (SELECT doc_id, licence, reading FROM kept WHERE r = 1) USING (doc_id, licence, reading)
"""


def op2_token_counts(spark, sf, tokenizers=TOKENIZERS):
    """Totals of all documents after an insert of everything, a delete of later copies of a text, and a recount of
    what is left where runs of blanks shrink to one. The delete comes twice and counts once."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"))
    text = F.regexp_replace("text", " +", " ")
    keyed = docs.select("doc_id", "source", "lang", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"),
                        "text", F.when(text != F.col("text"), text).alias("shrunk"))
    counters = {"words": word_count, "byte_bpe_50k": bpe_counter(spark, f"{tokenizers}/byte_bpe_50k.tiktoken")}
    counted = count_tokens(keyed, counters)
    again = count_tokens(counted.withColumnRenamed("shrunk", "text").withColumn("is_shrunk", F.col("text").isNotNull()).withColumnsRenamed(
        {c: f"old_{c}" for c in counters}), counters)
    rows = settled(again.select(
        "doc_id", "source", "lang", "a", "b", "is_shrunk",
        F.explode(F.array(*[F.struct(F.lit(c).alias("tokenizer"), F.col(f"old_{c}").alias("old_tokens"), F.col(c).alias("new_tokens"))
                            for c in counters])).alias("c")).select("doc_id", "source", "lang", "a", "b", "is_shrunk", "c.*"), "counts")
    first = settled(rows.groupBy("a", "b").agg(F.min("doc_id").alias("first")), "first")
    marked = rows.join(first, ["a", "b"]).withColumn("copy", F.col("doc_id") > F.col("first"))
    rollup = TokenRollup(spark, fresh_path(spark, "token-rollup"))
    rollup.commit("insert", signed(rows.select("*", F.lit("insert").alias("change")).drop("new_tokens").withColumn("new_tokens", F.col("old_tokens"))))
    copies = signed(marked.where("copy").withColumn("change", F.lit("delete")))
    rollup.commit("delete", copies)
    rollup.commit("delete", copies)
    rollup.commit("revise", signed(marked.where("is_shrunk and not coalesce(copy, false)").withColumn("change", F.lit("revise"))))
    return rollup.totals()


def op3_warc(spark, sf):
    """Per page: its record, read back from the archives that were written for the whole table."""
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN first_id <> page_id THEN first_id END AS refers_to
    FROM f
"""


def op4_suffix_dedup(spark, sf):
    """Per document: what is left without the byte strings of 400 that occur more than once, as sizes and a digest.
    ``text`` is also without passages of more than 50 words that occur more than once, which may have fewer bytes."""
    rows = remove_repeats(table(spark, sf, "documents"), 400, clean_words=51)
    return rows.withColumn("text", F.when(
        F.col("text").isNotNull(), F.make_valid_utf8(F.col("clean").cast("string")))).drop("kept_bytes", "clean")


def held_out(key):
    """Whether a row is kept from the fit: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def op5_language_id(spark, sf):
    """Per document: the predicted language and its calibrated probability."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = language.fit(docs.where(~F.col("held_out")), F.col("doc_id"))
    return language.identify(docs.select("doc_id", "held_out", "text"), model)


def op6_exact_topk(spark, sf):
    """The 5 best other rows for every 50th vector."""
    return top_k(integer_vectors(table(spark, sf, "embeddings")), F.col("vec_id") % 50 == 0, 5).withColumn(
        "rank", F.col("rank").cast("int"))


OP6_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, q.e AS asked, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
        FROM (SELECT DISTINCT vec_id, e FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op7_decontaminate(spark, sf):
    """Every document that holds a benchmark item, with the similarity and place of the best window."""
    return leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 0.8)


OP7_SQL = """
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents),
    i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
    j AS (SELECT item_id, w, least(len(w), 5) AS g, greatest(len(w) - 4, 1) AS m FROM i WHERE len(w) > 0),
    item_grams AS (
        SELECT item_id, m, g, gram, count(*) AS n
        FROM (SELECT item_id, m, g, unnest(list_transform(range(m), lambda p: list_slice(w, p + 1, p + g))) AS gram FROM j) GROUP BY ALL),
    doc_grams AS (
        SELECT doc_id, g, last, unnest(range(last)) AS pos, unnest(list_transform(range(last), lambda p: list_slice(w, p + 1, p + g))) AS gram
        FROM (SELECT doc_id, w, g, len(w) - g + 1 AS last FROM d, (SELECT DISTINCT g FROM j)) WHERE last > 0),
    hits AS (SELECT doc_id, item_id, m, last, pos, gram, n FROM doc_grams JOIN item_grams USING (g, gram)),
    starts AS (
        SELECT DISTINCT doc_id, item_id, start
        FROM (SELECT doc_id, item_id, m, last, unnest(range(greatest(pos - m + 1, 0), pos + 1)) AS start FROM hits) WHERE start + m <= last),
    shared AS (
        SELECT doc_id, item_id, start, m, sum(c) AS c
        FROM (SELECT doc_id, item_id, start, m, gram, least(count(*), any_value(n)) AS c
              FROM starts JOIN hits USING (doc_id, item_id) WHERE pos >= start AND pos < start + m GROUP BY ALL) GROUP BY ALL),
    scored AS (SELECT *, c / (2 * m - c) AS similarity FROM shared),
    best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r FROM scored WHERE similarity >= 0.8)
    SELECT doc_id, item_id, round(similarity, 6) AS similarity, start::INT AS first_word FROM best WHERE r = 1
"""


def op8_minhash(spark, sf):
    """Per document: its component of the links at 85 of 100, and whether it is the one that is kept."""
    return near_components(table(spark, sf, "documents"), 85)


def op9_toxicity(spark, sf):
    """Per document: expected severity, the likeliest grade and whether it is toxic."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return severity.grade(docs, severity.fit(docs, table(spark, sf, "labels"))).drop("text")


def op10_sentencepiece(spark, sf, tokenizers=TOKENIZERS):
    """Per document: its number of pieces, a digest of their ids, and whether decoding gives the text back."""
    model = pieces.share_model(spark, f"{tokenizers}/piece_bpe_32k.model")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return piece_digests(pieces.decode(pieces.encode(docs, model), model))


def piece_digests(rows):
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return rows.select(
        "doc_id", F.size("ids").alias("n_pieces"), ids.alias("ids_sha256"),
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), pieces.META, " ")).alias("round_trip"))


def op11_whitening(spark, sf):
    """Per vector and component: its whitened value, with the part of the variance that the component explains."""
    vectors = grid_vectors(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    model = fit_whitening(vectors, 16)
    return by_component(whiten(vectors, model), model)


def op12_alignment(spark, sf, tokenizers=TOKENIZERS):
    """Per document: how the tokens of two tokenizers lie upon each other, and how usual its links are in the table."""
    shared = alignment.share_tokenizers(spark, f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model")
    rows = alignment.score_links(alignment.align(table(spark, sf, "documents").select("doc_id", "text"), shared), shared)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op13_rank_bpe(spark, sf, tokenizers=TOKENIZERS):
    """Per document: its number of tokens, and digests of their ids and of the text that these decode to."""
    shared = rank_bpe.share_vocabulary(spark, f"{tokenizers}/word_bpe_49k.json")
    return rank_bpe.recode(table(spark, sf, "documents").select("doc_id", "text"), shared)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_token_counts, op3_warc, op4_suffix_dedup, op5_language_id, op6_exact_topk, op7_decontaminate,
    op8_minhash, op9_toxicity, op10_sentencepiece, op11_whitening, op12_alignment, op13_rank_bpe)}
ORACLES: dict[str, str] = {"op1_license_scan": OP1_SQL, "op3_warc": OP3_SQL, "op6_exact_topk": OP6_SQL, "op7_decontaminate": OP7_SQL}
