"""Byte-pair encoding and decoding by contiguous rank arrays, for vocabularies whose words end in a mark.

A word is held as its parts and, beside them, the merge rank of each part with the next. The least rank is looked for, the
boundary behind it deleted, and the two ranks beside it looked up anew, until no neighbours merge. Words of more than
``LONG`` parts, for which the repeated scans would be quadratic, take the same merges from a heap. What stands between
blanks is remembered per task, as most of a text was met before; no word holds a blank, nor does a character combine with one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from wickline.llm.spans import small_batches

#: Parts from which on a word's merges are kept in a heap.
LONG = 128
#: Stretches between blanks, and words, that a worker remembers, and their greatest length; a memory is emptied when it is full.
REMEMBERED, LONGEST = 300_000, 64
NEVER = 1 << 60
RECODED = ["n_tokens", "ids_sha256", "decoded_sha256"]

_loaded: dict[int, "RankBpe"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes are themselves, the others
    are numbered from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


class _Known(dict):
    """The ids of stretches that were met, as bytes; others are asked for."""

    def __init__(self, ask: Callable[[str], bytes]):
        super().__init__()
        self.ask = ask

    def __missing__(self, stretch: str) -> bytes:
        found = self.ask(stretch)
        if len(stretch) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[stretch] = found
        return found


class RankBpe:
    """A vocabulary with its merge ranks, and how its file normalises and cuts a text."""

    def __init__(self, file: str):
        """``file``: the text of a tokenizer file. Kinds that are not built here are refused."""
        parts = json.loads(file)
        model, cut, norm = parts["model"], parts["pre_tokenizer"], parts["normalizer"]
        if (model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model["continuing_subword_prefix"]
                or model["ignore_merges"] or model["byte_fallback"]):
            raise ValueError("only plain merges are built")
        if [n["type"] for n in norm["normalizers"]] != ["NFC", "Replace", "Lowercase"] or norm["normalizers"][1]["content"] != " ":
            raise ValueError("only NFC, one blank for white space, and lower case are built")
        steps = cut["pretokenizers"]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or (
                steps[1]["use_regex"] or steps[1]["add_prefix_space"]):
            raise ValueError("only words found by a pattern, as bytes, are built")
        if parts["post_processor"] or parts["decoder"] or any(
                t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"]):
            raise ValueError("only special tokens that are found as they are, and joined decoding, are built")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.library = Tokenizer.from_str(file)
        self.end = model["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.merged = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in reversed([*enumerate(merges)])}
        self.letters = byte_letters()
        self.inner = [self.ids[c] for c in self.letters]
        self.last = [self.ids[c + self.end] for c in self.letters]
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile(f"({'|'.join(names)})") if names else None
        self.text_of = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.words = _Known(lambda word: np.array(self.word(word), dtype=np.int32).tobytes())
        self.known, self.rare = _Known(partial(self._stretch, cut=self._words)), partial(self._stretch, cut=self._library_words)
        self.alike, self.unlike = set(map(chr, range(128))), set()

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        raw = word.encode("utf-8", "surrogatepass")
        ids = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return self._by_heap(ids) if len(ids) > LONG else self._by_scan(ids)

    def _rank(self, a: int, b: int) -> int:
        found = self.merged.get((a, b))
        return found[0] if found else NEVER

    def _by_scan(self, ids: list[int]) -> list[int]:
        ranks = [self._rank(a, b) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            ids[i] = self.merged[ids[i], ids[i + 1]][1]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = self._rank(ids[i - 1], ids[i])
            if i < len(ranks):
                ranks[i] = self._rank(ids[i], ids[i + 1])
        return ids

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges, least rank and then leftmost first; an entry counts if its two parts are still neighbours."""
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(self._rank(ids[i], ids[i + 1]), i, ids[i], ids[i + 1]) for i in range(n - 1)]
        heap = [x for x in heap if x[0] < NEVER]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[a, b][1], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0 and (rank := self._rank(ids[left], ids[after[left]])) < NEVER:
                    heapq.heappush(heap, (rank, left, ids[left], ids[after[left]]))
        return [x for x in ids if x >= 0]

    def _stretch(self, stretch: str, cut: Callable[[str], list[str]]) -> bytes:
        return b"".join(map(self.words.__getitem__, cut(stretch)))

    def _unlike(self, text: str) -> bool:
        """Whether the text has a character that the library normalises or cuts in another way than Python, which knows
        a newer Unicode. Each character is asked about once."""
        if text.isascii():
            return False
        fresh = set(text)
        if not fresh.isdisjoint(self.unlike):
            return True
        for c in fresh - self.alike:
            probe = f"a{c}b{c}{c}1{c}"
            (self.alike if self._words(probe) == self._library_words(probe) else self.unlike).add(c)
        return not fresh.isdisjoint(self.unlike)

    def _words(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # Each character by itself, as a final sigma would else become another letter.
        return self.pattern.findall("".join([c.lower() for c in text]) if "Σ" in text else text.lower())

    def _library_words(self, text: str) -> list[str]:
        byte_of = {c: b for b, c in enumerate(self.letters)}
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in w).decode("utf-8", "surrogatepass") for w, _ in cut]

    def encode(self, text: str) -> np.ndarray:
        out = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
            elif self._unlike(part):
                out.append(self.rare(part))
            else:
                out.extend(map(self.known.__getitem__, part.split(" ")))
        return np.frombuffer(b"".join(out), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, with blanks between, as a file without a decoder says. Unknown ids are left out."""
        try:
            return " ".join(map(self.text_of.__getitem__, ids))
        except KeyError:
            return " ".join([self.text_of[i] for i in ids if i in self.text_of])


def share_vocabulary(spark: SparkSession, path: str):
    """A tokenizer file (a few MB), read here and sent to each executor once."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _bpe(shared) -> RankBpe:
    """One per worker and vocabulary."""
    name = hash(shared.value)
    if name not in _loaded:
        _loaded[name] = RankBpe(shared.value)
    return _loaded[name]


def _encode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(shared)
    for batch in batches:
        ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
        edges = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.ListArray.from_arrays(pa.array(edges), values)], names=[*names, "ids"])


def _decode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(shared)
    for batch in batches:
        texts = [bpe.decode(x.values.to_pylist()) if x.is_valid else None for x in batch.column("ids")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "decoded"])


def _recode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    bpe = _bpe(shared)
    for batch in batches:
        sizes, digests, texts = [], [], []
        for text in batch.column("text").to_pylist():
            ids = bpe.encode(text or "")
            sizes.append(len(ids))
            digests.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            texts.append(hashlib.sha256(bpe.decode(ids.tolist()).encode("utf-8", "surrogatepass")).hexdigest())
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sizes, pa.int64()), *(pa.array(x, pa.string()) for x in (digests, texts))],
                                         names=[*names, *RECODED])


def _kept(frame: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields)


def encode(docs: DataFrame, shared) -> DataFrame:
    """Every row of ``docs`` with ``ids`` (array<int>; replaced if there) of its whole ``text``.

    Null, empty and blank texts have no ids. Special tokens that stand in a text become their ids, as the tokenizers
    library has it. ``shared`` is the vocabulary from ``share_vocabulary``. Repeated rows are encoded each, other columns pass
    unseen, an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids")
    return docs.mapInArrow(partial(_encode, shared=shared, names=docs.columns), f"{_kept(docs)}ids array<int>")


def decode(rows: DataFrame, shared) -> DataFrame:
    """Every row with ``decoded`` (replaced if there): the text of its ``ids``; null for null ids, empty for none."""
    small_batches(rows.sparkSession)
    rows = rows.drop("decoded")
    return rows.mapInArrow(partial(_decode, shared=shared, names=rows.columns), f"{_kept(rows)}decoded string")


def _digest(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("ids")
        found = [hashlib.sha256(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()).hexdigest() if x.is_valid else None
                 for x in column]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.string())], names=[*names, "ids_sha256"])


def digest_ids(rows: DataFrame) -> DataFrame:
    """Every row with ``ids_sha256`` (replaced if there): lower-case hex SHA-256 of its ``ids`` as little-endian unsigned
    32-bit numbers; null for null ids."""
    small_batches(rows.sparkSession)
    rows = rows.drop("ids_sha256")
    return rows.mapInArrow(partial(_digest, names=rows.columns), f"{_kept(rows)}ids_sha256 string")


def recode(docs: DataFrame, shared) -> DataFrame:
    """``encode``, ``decode`` and ``digest_ids`` in one step, for those who need no ids or texts: every row without its
    ``text``, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (replaced if there). Rows are treated as these do."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*RECODED)
    kept = docs.drop("text")
    return docs.mapInArrow(partial(_recode, shared=shared, names=kept.columns), f"{_kept(kept)}n_tokens long, ids_sha256 string, decoded_sha256 string")
