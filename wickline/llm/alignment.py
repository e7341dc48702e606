"""Token spans of two tokenizers over the same bytes: where both end, which tokens overlap, and how often the ids meet.

The tokenizers library gives each token's place in characters, SentencePiece gives its pieces' places in bytes (the spans of its
immutable proto, which the installed version hands out as ``offset_mapping``). These are coarse cuts: tokens that share a
character, and byte-fallback pieces, have the place of the whole character. Such runs are refined by the bytes that their
tokens decode to.

A text is first cut before each blank that follows a character other than white space. No token of either vocabulary
crosses such a place, so the parts are aligned by themselves and remembered, and a text costs little more than its new words.
What is counted afterwards, the links of ids, is read from the groups that were written; there are far fewer different ones.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wickline.llm.rank_bpe import byte_letters
from wickline.llm.spans import small_batches
from wickline.session import fresh_path, settled

META = "▁"
#: Parts or groups that a worker remembers, and their characters together; the memory is emptied when either is reached.
REMEMBERED, CHARACTERS = 600_000, 24 << 20
#: Pairs of ids up to which the counts are broadcast (16 bytes each); beyond, the rows' pairs are joined with them.
MOST_PAIRS = 4_000_000
COUNTED = "n_a long, n_b long, n_groups long, n_links long, groups string"
#: Groups that one sum of link counts covers, and characters of new parts that are encoded together.
COUNTED_AT_ONCE, AT_ONCE = 4 << 20, 1 << 16

_loaded: dict[int, "Aligner"] = {}


def refined_ends(begins: list[int], ends: list[int], lengths: list[int]) -> list[int] | None:
    """Byte ends of tokens from their coarse places and the numbers of bytes they decode to; None where these disagree.

    A coarse end is sure where the token has a place of its own and the next one begins there. Between sure ends the
    decoded lengths tell where each token ends.
    """
    out, at = [], 0
    for i, (begin, end, length) in enumerate(zip(begins, ends, lengths)):
        at += length
        if begin < end and (i + 1 == len(ends) or begins[i + 1] >= end):
            if at != end:
                return None
        out.append(at)
    return out


def sure_ends(places: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
    """``refined_ends`` for many tokens at once, from their places as rows of begin and end."""
    ends = np.cumsum(lengths)
    begin, end = places[:, 0], places[:, 1]
    sure = (begin < end) & (np.append(begin[1:], end[-1:]) >= end)
    return ends if (ends[sure] == end[sure]).all() and (lengths > 0).all() else None


def shared_ends(ids_a: list[int], ends_a: list[int], ids_b: list[int], ends_b: list[int]) -> list[str]:
    """The ids between byte places where both tokenizers end, as ``a1,a2|b1``."""
    if ends_a == ends_b:
        return [f"{a}|{b}" for a, b in zip(ids_a, ids_b)]
    groups, i, j, m, size = [], 0, 0, 0, len(ends_b)
    for k, end in enumerate(ends_a):
        while m < size and ends_b[m] < end:
            m += 1
        if ends_b[m] == end:
            m += 1
            groups.append(f"{ids_a[k]}|{ids_b[j]}" if k == i and m == j + 1 else
                          f"{','.join(map(str, ids_a[i:k + 1]))}|{','.join(map(str, ids_b[j:m]))}")
            i, j = k + 1, m
    return groups


class Aligner:
    """Both vocabularies, and the parts that were aligned already."""

    def __init__(self, file: str, model: bytes):
        parts = json.loads(file)
        self.a = Tokenizer.from_str(file)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = {c: b for b, c in enumerate(byte_letters())}
        as_bytes = lambda t: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
        self.bytes_a = {i: as_bytes(t) for t, i in parts["model"]["vocab"].items()}
        self.bytes_a |= {t["id"]: t["content"].encode() for t in parts["added_tokens"] if t["id"] not in self.bytes_a}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(META, " ").encode() for i, p in enumerate(pieces)]
        self.lengths_a = np.zeros(max(self.bytes_a) + 1, dtype=np.int64)
        self.lengths_a[list(self.bytes_a)] = list(map(len, self.bytes_a.values()))
        self.lengths_b = np.array(list(map(len, self.bytes_b)), dtype=np.int64)
        cut = parts["pre_tokenizer"] or {}
        by_word = (parts["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
                   and not any(META in p.lstrip(META) for p in pieces))
        # The blank that begins a part is left out; each part stands for a blank and its text.
        self.cut = re.compile(rf" (?<=[^\s{META}] )(?= *[^ ])") if by_word else None
        self.clear()

    def clear(self) -> None:
        """Forget the parts and the links of groups."""
        self.known: dict[str, tuple[int, int, int, str] | None] = {}
        self.numbers: dict[str, int] = {}
        self.pairs: list[np.ndarray] = []
        self.characters = 0

    @property
    def full(self) -> bool:
        return len(self.known) + len(self.pairs) >= REMEMBERED or self.characters >= CHARACTERS

    def spans(self, part: str) -> tuple[list[int], list[int], list[int], list[int]] | None:
        """Ids and byte ends in blank + part of either tokenizer; None where the tokens' bytes are others."""
        text = " " + part
        a, b = self.a.encode(text, add_special_tokens=False), self.b.encode(part, return_type="offset_mapping", return_bytes=True)
        ids_a, ids_b, offsets = a.ids, b["ids"], a.offsets
        raw = text.encode("utf-8", "surrogatepass")
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return None
        if len(raw) == len(text):  # every character is a byte, so no tokens share one
            return ids_a, [e for _, e in offsets], ids_b, [e + 1 for _, e in b["offsets"]]
        byte_at = [i for i, x in enumerate(raw) if x & 0xC0 != 0x80]  # from characters to bytes
        byte_at.append(len(raw))
        ends_a = refined_ends([byte_at[x] for x, _ in offsets], [byte_at[x] for _, x in offsets], [len(self.bytes_a[i]) for i in ids_a])
        # The blank that the model adds has no place of its own: the first piece begins with it.
        begins = [0, *(x + 1 for x, _ in b["offsets"][1:])]
        ends_b = refined_ends(begins, [x + 1 for _, x in b["offsets"]], [len(self.bytes_b[i]) for i in ids_b])
        return None if ends_a is None or ends_b is None else (ids_a, ends_a, ids_b, ends_b)

    def _learn_one(self, part: str) -> None:
        found = self.spans(part)
        groups = shared_ends(*found) if found else []
        self.known[part] = (len(found[0]), len(found[2]), len(groups), ";".join(groups)) if found else None

    def _learn(self, parts: list[str]) -> None:
        """Align new parts: those that stay apart when joined in one text of ``AT_ONCE`` characters, the others one by one."""
        self.characters += sum(map(len, parts))
        held, size = [], 0
        for part in parts:
            if not self.cut or not part or part[-1].isspace() or META in part:
                self._learn_one(part)
                continue
            held.append(part)
            size += len(part) + 1
            if size > AT_ONCE:
                self._learn_joined(held)
                held, size = [], 0
        if held:
            self._learn_joined(held)

    def _learn_joined(self, parts: list[str]) -> None:
        text = " " + " ".join(parts)
        a, b = self.a.encode(text, add_special_tokens=False), self.b.encode(text[1:], return_type="offset_mapping", return_bytes=True)
        raw = text.encode("utf-8", "surrogatepass")
        ids_a, ids_b = a.ids, b["ids"]
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw == b"".join(map(self.bytes_b.__getitem__, ids_b)):
            at_a, at_b = (np.fromiter(chain.from_iterable(x), np.int64).reshape(-1, 2) for x in (a.offsets, b["offsets"]))
            at_b += 1
            at_b[0, 0] = 0  # the first piece begins with the blank that the model adds
            if len(raw) != len(text):  # from characters to bytes
                places = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
                at_a = np.append(places, len(raw))[at_a]
            ends_a = sure_ends(at_a, self.lengths_a[ids_a])
            ends_b = sure_ends(at_b, self.lengths_b[ids_b])
            part_ends = np.cumsum([len(p) + 1 if p.isascii() else len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
            if ends_a is not None and ends_b is not None:
                common = np.intersect1d(ends_a, ends_b, assume_unique=True)
                last = np.searchsorted(common, part_ends)
                if (last < len(common)).all() and (common[last] == part_ends).all():
                    self._keep_joined(parts, ids_a, np.searchsorted(ends_a, common), ids_b, np.searchsorted(ends_b, common), last)
                    return
        for part in parts:
            self._learn_one(part)

    def _keep_joined(self, parts: list[str], ids_a: list[int], to_a: np.ndarray, ids_b: list[int], to_b: np.ndarray, last: np.ndarray) -> None:
        """Remember the parts. ``to_a`` and ``to_b`` are the last tokens of each group, ``last`` the last group of each part."""
        a, b = list(map(str, ids_a)), list(map(str, ids_b))
        groups, i, j = [], 0, 0
        for k, m in zip((to_a + 1).tolist(), (to_b + 1).tolist()):
            groups.append(f"{a[i]}|{b[j]}" if k == i + 1 and m == j + 1 else f"{','.join(a[i:k])}|{','.join(b[j:m])}")
            i, j = k, m
        n_a, n_b, n_groups = (np.diff(x, prepend=-1).tolist() for x in (to_a[last], to_b[last], last))
        first = 0
        for part, x, y, z in zip(parts, n_a, n_b, n_groups):
            self.known[part] = x, y, z, ";".join(groups[first:first + z])
            first += z

    def describe_all(self, texts: list[str | None]) -> list[tuple[int, int, int, str]]:
        """Of each text: numbers of tokens of either kind and of groups, and the groups; nothing where the tokens' bytes
        differ from the text."""
        out, held, size = [], [], 0
        for i, text in enumerate(texts):
            held.append((self.cut.split(text) if self.cut else [text]) if text else [])
            size += len(text or "")
            if size > AT_ONCE * 16 or i + 1 == len(texts):
                if self.full:
                    self.clear()
                if fresh := [w for w in dict.fromkeys(chain.from_iterable(held)) if w not in self.known]:
                    self._learn(fresh)
                for words in held:
                    found = list(map(self.known.__getitem__, words))
                    if not found or None in found:
                        out.append((0, 0, 0, ""))
                    else:
                        n_a, n_b, n_groups, groups = zip(*found)
                        out.append((sum(n_a), sum(n_b), sum(n_groups), ";".join(groups)))
                held, size = [], 0
        return out

    def describe(self, text: str | None) -> tuple[int, int, int, str]:
        return self.describe_all([text])[0]

    def links(self, group: str) -> np.ndarray:
        """The pairs of ids, packed into one number, whose bytes overlap within a group."""
        a, b = group.split("|")
        if "," not in group:
            return np.array([int(a) << 32 | int(b)], dtype=np.int64)
        ids_a, ids_b = [int(x) for x in a.split(",")], [int(x) for x in b.split(",")]
        end_a, end_b, i, j, out = len(self.bytes_a[ids_a[0]]), len(self.bytes_b[ids_b[0]]), 0, 0, []
        while True:
            out.append(ids_a[i] << 32 | ids_b[j])
            on_a, on_b = end_a <= end_b, end_b <= end_a
            if on_a and i + 1 == len(ids_a):
                return np.array(out, dtype=np.int64)
            if on_a:
                i += 1
                end_a += len(self.bytes_a[ids_a[i]])
            if on_b:
                j += 1
                end_b += len(self.bytes_b[ids_b[j]])

    def numbered(self, groups: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A number for each group of all rows, and where each row's begin and end; ``pairs`` has the links of each number.

        Arrow cuts the texts and finds the different groups of a batch; only these are looked up.
        """
        lists = pc.split_pattern(pc.if_else(pc.equal(groups, ""), None, groups), ";")
        edges = np.cumsum(np.r_[0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)], dtype=np.int64)
        coded = lists.flatten().dictionary_encode()
        numbers, found = self.numbers, []
        for name in coded.dictionary.to_pylist():
            number = numbers.get(name)
            if number is None:
                number = numbers[name] = len(self.pairs)
                self.pairs.append(self.links(name))
                self.characters += len(name)
            found.append(number)
        return np.array(found, dtype=np.int64)[coded.indices.to_numpy(zero_copy_only=False)], edges

    def pair_counts(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of ids, packed, and how many links of these groups hold them."""
        if not len(numbers):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if 8 * len(numbers) < len(self.pairs):
            used, times = np.unique(numbers, return_counts=True)
        else:
            times = np.bincount(numbers)
            used = np.flatnonzero(times)
            times = times[used]
        held = [self.pairs[i] for i in used.tolist()]
        pairs, weights = np.concatenate(held), np.repeat(times, list(map(len, held)))
        order = np.argsort(pairs, kind="stable")
        pairs, weights = pairs[order], weights[order]
        first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        return pairs[first], np.add.reduceat(weights, first)


def share_tokenizers(spark: SparkSession, file: str, model: str):
    """The tokenizer file and the piece model (some MB), read here and sent to each executor once."""
    with open(file, encoding="utf-8") as a, open(model, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def _aligner(shared, fresh: bool = True) -> Aligner:
    """One per worker; without ``fresh`` it remembers the parts of the worker's earlier tasks."""
    name = hash(shared.value)
    if name not in _loaded:
        _loaded[name] = Aligner(*shared.value)
    if fresh:
        _loaded[name].clear()
    return _loaded[name]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _kept(frame: DataFrame) -> tuple[list[str], str]:
    return frame.columns, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def _describe(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    aligner = _aligner(shared, fresh=False)
    for batch in batches:
        found = aligner.describe_all(batch.column("text").to_pylist())
        n = [[x[k] for x in found] for k in range(3)]
        # Every byte place where a token ends also ends one link.
        links = [a + b - g for a, b, g in zip(*n)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in names), *(pa.array(x, pa.int64()) for x in (*n, links)), pa.array([x[3] for x in found], pa.string())],
            names=[*names, *_names(COUNTED)])


def align(docs: DataFrame, shared) -> DataFrame:
    """Every row of ``docs`` without its ``text``, with the alignment of blank + text under the two tokenizers.

    ``n_a`` and ``n_b`` count the tokens, ``n_groups`` the stretches between byte places where both end, ``n_links`` the
    pairs of tokens that share a byte. ``groups`` has the ids as ``a1,a2|b1;a3|b2,b3``. Texts that are null or empty, or whose
    tokens decode to other bytes (such as those with the model's own blank symbol), have no tokens: zeros and an empty text.
    Repeated rows are aligned each; columns of these names are replaced, others pass unseen; an empty table gives an
    empty result. ``shared`` comes from ``share_tokenizers``.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*_names(COUNTED)).withColumn("text", F.col("text").cast("string"))
    names, kept = _kept(docs.drop("text"))
    return docs.mapInArrow(partial(_describe, shared=shared, names=names), f"{kept}{COUNTED}")


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    aligner, seen, held = _aligner(shared), [], 0

    def summed() -> pa.RecordBatch:
        pairs, n = aligner.pair_counts(np.concatenate([np.empty(0, np.int64), *seen]))
        return pa.RecordBatch.from_arrays(
            [pa.array((pairs >> 32).astype(np.int32)), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    for batch in batches:
        numbers, _ = aligner.numbered(batch.column(0))
        seen.append(numbers)
        held += len(numbers)
        if aligner.full or held > COUNTED_AT_ONCE:
            yield summed()
            seen, held = [], 0
            if aligner.full:
                aligner.clear()
    yield summed()


def link_counts(aligned: DataFrame, shared) -> DataFrame:
    """(a, b, n): how many links of the whole table hold each pair of ids. Tasks sum their rows before the shuffle."""
    small_batches(aligned.sparkSession)
    parts = aligned.select("groups").mapInArrow(partial(_count, shared=shared), "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _weigh(batches: Iterator[pa.RecordBatch], shared, names: list[str], counts) -> Iterator[pa.RecordBatch]:
    """The sums over each row's links, from the broadcast counts."""
    aligner, (keys, n, best) = _aligner(shared), counts.value
    # Of each known group, its sums.
    worth = np.empty((0, 2), dtype=np.int64)
    for batch in batches:
        if aligner.full:
            aligner.clear()
            worth = worth[:0]
        numbers, edges = aligner.numbered(batch.column("groups"))
        if fresh := aligner.pairs[len(worth):]:
            at = np.searchsorted(keys, np.concatenate(fresh))
            first = np.cumsum([0, *map(len, fresh[:-1])])
            worth = np.r_[worth, np.stack([np.add.reduceat(x[at], first) for x in (best, n)], axis=1)]
        upto = np.zeros((len(numbers) + 1, 2), dtype=np.int64)
        np.cumsum(worth[numbers], axis=0, out=upto[1:])
        sums = upto[edges[1:]] - upto[edges[:-1]]
        yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy())],
                                         names=[*names, "n_best", "count_sum"])


def _own_pairs(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Each row's distinct pairs of ids and how often it links them."""
    aligner = _aligner(shared)
    for batch in batches:
        if aligner.full:
            aligner.clear()
        numbers, edges = aligner.numbered(batch.column("groups"))
        out = [aligner.pair_counts(numbers[i:j]) for i, j in zip(edges[:-1], edges[1:])]
        lists = [pa.array([x[k] for x in out], pa.list_(pa.int64())) for k in range(2)]
        yield pa.RecordBatch.from_arrays([batch.column("~row"), *lists], names=["~row", "pairs", "times"])


def score_links(aligned: DataFrame, shared, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Every row of ``align`` with ``count_sum``, how often the two ids of each of its links are linked in the whole table,
    added up, and ``n_best``, the links for which no other id of the first tokenizer is linked more often with that id of
    the second (ties count). Rows without tokens count nowhere and have zeros; columns of these names are replaced.

    The rows are written first. The counts of pairs are broadcast up to ``most_pairs`` of them; with more, each row's distinct
    pairs are joined with them.
    """
    spark = aligned.sparkSession
    small_batches(spark)
    aligned = aligned.drop("n_best", "count_sum").withColumn("~row", F.monotonically_increasing_id())
    path = fresh_path(spark, "aligned")
    aligned.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(aligned.schema).parquet(path)
    counts = settled(link_counts(rows, shared), "link-counts")
    packed = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")
    if counts.count() <= most_pairs:
        found = counts.select(packed.alias("key"), "b", "n").toArrow()
        key, b, n = (found.column(c).to_numpy() for c in ("key", "b", "n"))
        most = np.zeros(int(b.max(initial=0)) + 1, dtype=np.int64)
        np.maximum.at(most, b, n)
        order = np.argsort(key)
        given = spark.sparkContext.broadcast((key[order], n[order], (n == most[b])[order].astype(np.int64)))
        names, kept = _kept(rows.drop("~row"))
        return rows.drop("~row").mapInArrow(partial(_weigh, shared=shared, names=names, counts=given),
                                            f"{kept}n_best long, count_sum long")
    most = settled(counts.groupBy("b").agg(F.max("n").alias("most")), "most")
    ranked = counts.join(most, "b").select(packed.alias("pair"), "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    own = rows.select("~row", "groups").mapInArrow(partial(_own_pairs, shared=shared), "`~row` long, pairs array<long>, times array<long>")
    summed = own.select("~row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("~row", "p.pairs", "p.times").join(
        ranked, F.col("pairs") == F.col("pair")).groupBy("~row").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    whole = rows.join(summed, "~row", "left").drop("~row")
    return whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
