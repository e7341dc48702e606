"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are composed with a text: the normaliser (a blank before the text, blanks as the meta symbol),
the pieces (a trie whose accepting arcs emit a piece at the cost of minus its score), and the byte fallback, which
emits the UTF-8 bytes of a character at a cost above all pieces. The encoding is the path of least cost, that is,
the shortest path in the tropical semiring; of equal paths the one with fewer pieces, then the one whose last piece
is longer. No piece holds the meta symbol after another character, so paths meet before each run of meta
symbols, and the shortest path of a text joins those of its units, which are remembered.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from wickline.llm.spans import small_batches

META = "▁"
#: Costs are whole numbers, so that long sums stay exact: millionths of a score. A byte costs more than any piece.
UNIT_COST, BYTE_COST = 1_000_000, 10 ** 17
#: Units that a worker remembers, and their greatest length; the memory is emptied when it is full.
REMEMBERED, LONGEST = 600_000, 64

_compiled: dict[int, "Transducer"] = {}


class Transducer:
    """The compiled normaliser, pieces and byte fallback of one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], dummy_prefix: bool = True):
        """``pieces``: text and score by id; a text that is None takes no part. ``byte_ids``: the ids of the 256 bytes."""
        self.dummy_prefix, self.byte_ids = dummy_prefix, byte_ids
        self.bytes_of = [b""] * len(pieces)
        #: A state is its arcs by character, and the least cost and the id of a piece that ends there.
        self.root: list = [{}, None, None]
        joined = ""
        for i, (text, score) in enumerate(pieces):
            if not text:
                continue
            self.bytes_of[i] = text.encode()
            state = self.root
            for c in text:
                state = state[0].setdefault(c, [{}, None, None])
            cost = round(-score * UNIT_COST)
            if state[1] is None or state[1] > cost:
                state[1:] = cost, i
            if len(text) > 1:
                joined += text
            if META in text.lstrip(META):
                raise ValueError("pieces that cross words are not supported")
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        # Characters of no longer piece stand alone on every path; white space of that kind also ends a unit.
        alone = "".join(re.escape(c) for c in "\n\r\t" if c not in joined)
        self.units = re.compile(f"[{alone}]|{META}*[^{META}{alone}]+|{META}+" if alone else f"{META}*[^{META}]+|{META}+")
        self.known: dict[str, bytes] = {}

    @classmethod
    def load(cls, model: bytes) -> "Transducer":
        """The pieces of a model file. Control pieces and the unknown piece are never emitted."""
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.get_piece_size())
        byte_ids = [i for i in ids if sp.is_byte(i)]
        left_out = {*byte_ids, *(i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if len(byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        return cls([("" if i in left_out else sp.id_to_piece(i), sp.get_score(i)) for i in ids], byte_ids)

    def normalise(self, text: str) -> str:
        """Meta symbols for blanks, one more before a text that is not empty."""
        return (META if self.dummy_prefix and text else "") + text.replace(" ", META)

    def shortest_path(self, unit: str) -> list[int]:
        """The ids on the path of least cost over one unit."""
        n = len(unit)
        cost, count, came, piece = [0] + [None] * n, [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for i in range(n):
            base, steps, state, covered = cost[i], count[i] + 1, self.root, False
            for j in range(i, n):
                state = state[0].get(unit[j])
                if state is None:
                    break
                if (own := state[1]) is not None:
                    covered = covered or j == i
                    total, old = base + own, cost[j + 1]
                    if old is None or total < old or total == old and steps < count[j + 1]:
                        cost[j + 1], count[j + 1], came[j + 1], piece[j + 1] = total, steps, i, state[2]
            if not covered:  # bytes cost more than any piece, so they matter only here
                raw = unit[i].encode("utf-8", "surrogatepass")
                total = base + BYTE_COST * len(raw)
                if cost[i + 1] is None or total < cost[i + 1]:
                    cost[i + 1], count[i + 1], came[i + 1], piece[i + 1] = total, count[i] + len(raw), i, raw
        path, at = [], n
        while at:
            if isinstance(piece[at], bytes):
                path.extend(self.byte_ids[b] for b in reversed(piece[at]))
            else:
                path.append(piece[at])
            at = came[at]
        path.reverse()
        return path

    def _unit(self, unit: str) -> bytes:
        found = array("i", self.shortest_path(unit)).tobytes()
        if len(unit) <= LONGEST:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[unit] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        get, miss = self.known.get, self._unit
        return np.frombuffer(b"".join([get(u) or miss(u) for u in self.units.findall(self.normalise(text))]), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: the inverse of ``encode`` for every text without the meta symbol itself."""
        table = self.bytes_of
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(META, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def _transducer(shared) -> Transducer:
    """One per worker and model: compiling takes longer than a document."""
    name = hash(shared.value)
    if name not in _compiled:
        _compiled[name] = Transducer.load(shared.value)
    return _compiled[name]


def share_model(spark: SparkSession, path: str):
    """A model file (some hundred KB), read here and sent to each executor once."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _encode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    transducer = _transducer(shared)
    for batch in batches:
        ids = [transducer.encode(t or "") for t in batch.column("text").to_pylist()]
        edges = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.ListArray.from_arrays(pa.array(edges), values)], names=[*names, "ids"])


def _decode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    transducer = _transducer(shared)
    for batch in batches:
        column = batch.column("ids")
        texts = [transducer.decode(x.values.to_numpy()) if x.is_valid else None for x in column]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "decoded"])


def _recode(batches: Iterator[pa.RecordBatch], shared, names: list[str]) -> Iterator[pa.RecordBatch]:
    try:
        yield from _decode(_encode(batches, shared, names), shared, [*names, "ids"])
    finally:
        # The worker lives on and serves other stages, and the units take over 100 MB when they are many.
        _transducer(shared).known.clear()


def encode(docs: DataFrame, shared) -> DataFrame:
    """Every row of ``docs`` with ``ids`` (array<int>; replaced if there) of its whole text; null and empty texts have none.

    ``shared`` is the model from ``share_model``. Repeated rows are encoded each; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(partial(_encode, shared=shared, names=docs.columns), f"{kept}, ids array<int>")


def recode(docs: DataFrame, shared) -> DataFrame:
    """``decode(encode(docs))`` in one worker a task, which keeps no units after it: for jobs with other stages."""
    small_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(partial(_recode, shared=shared, names=docs.columns), f"{kept}, ids array<int>, decoded string")


def decode(rows: DataFrame, shared) -> DataFrame:
    """Every row with ``decoded`` (replaced if there): the text of its ``ids``, null for null ids."""
    small_batches(rows.sparkSession)
    rows = rows.drop("decoded")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(partial(_decode, shared=shared, names=rows.columns), f"{kept}, decoded string")
