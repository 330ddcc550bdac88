"""Best-fit packing of tokenised documents into sequences of bounded length.

Two steps. Tokenising is a map over rows that keeps only lengths and checksums;
packing works on that narrow table. Pieces are dealt at random into groups of
about ``group_size`` and each group is packed on its own, so the number of
groups grows with the data while a task's memory does not.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.scratch import materialize

#: Words, and ends of words, whose ids a worker remembers; when full, it starts afresh.
REMEMBERED, REMEMBERED_ENDS = 300_000, 50_000
#: The splitting rule of the byte-level vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """Letter of a byte-level vocabulary -> byte: printable bytes stand for themselves, the rest follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Piece of a text -> its ids; forgets everything when full."""

    def __init__(self, learn, limit: int):
        self.learn, self.limit = learn, limit

    def __missing__(self, piece: str) -> bytes:
        got = self.learn(piece)
        if len(self) >= self.limit:
            self.clear()
        self[piece] = got
        return got


class Encoder:
    """Token ids of whole texts as little-endian 32-bit words, by one tokenizer file.

    A blank before a non-blank always begins a token, so a text is cut there and
    the ids of each distinct piece are remembered. Pieces are merged with the
    file's own vocabulary. Texts that hold one of the file's added tokens go to
    the tokenizer as a whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [x["content"] for x in spec["added_tokens"]]
        letters = byte_letters()
        ranks = {bytes(map(letters.__getitem__, k)): v for k, v in spec["model"]["vocab"].items() if k not in added}
        self.merge = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)").search
        self.tails = Known(lambda x: array("I", self.merge(x)).tobytes(), REMEMBERED_ENDS)
        self.words = Known(self._word, REMEMBERED)

    def _word(self, piece: str) -> bytes:
        """Ids of a blank and ``piece``. Letters end where the first other character begins a token."""
        letters = _LETTERS.match(piece)[0]
        if letters and letters != piece and letters.isalpha():
            return self.words[letters] + self.tails[piece[len(letters) :]]
        return array("I", self.merge(" " + piece)).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.added(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # A blank followed by white space stays inside its piece.
        first, *rest = _CUT.split(text) if _BLANKS.search(text) else text.split(" ")
        head = array("I", self.merge(first)).tobytes()
        return head + b"".join(map(self.words.__getitem__, rest))


_LETTERS = re.compile(r"[^\W\d_]*")
_BLANKS = re.compile(r" (?:\s|$)")
_CUT = re.compile(r" (?=\S)")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def token_pieces(docs: DataFrame, vocabulary: str, max_tokens: int, end_id: int) -> DataFrame:
    """Cut each document's ids (closed by ``end_id``) into pieces of ``max_tokens``.

    Only longer documents are cut; what does not fill a piece becomes the first
    one. Null text is empty text: one piece that holds ``end_id`` alone. Null and
    repeated ``doc_id`` are kept as they are. Columns other than ``doc_id`` and
    ``text`` are not read.
    """
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * max_tokens

    def run(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            rows: list[int] = []
            out: list[list[int]] = [[], [], [], []]
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "") + end
                first = len(ids) % step or step
                at = 0
                for piece, stop in enumerate(range(first, len(ids) + 1, step)):
                    rows.append(row)
                    for column, value in zip(out, (piece, at // 4, (stop - at) // 4, zlib.crc32(ids[at:stop]))):
                        column.append(value)
                    at = stop
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(out[0], pa.int32())]
                + [pa.array(x, pa.int64()) for x in out[1:]],
                names=PIECES.names,
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


@dataclass(frozen=True)
class Bins:
    """Capacities of a sequence and how a bin is chosen among those with room.

    ``attention`` bounds the sum of squared piece lengths (block-diagonal
    attention). ``rule`` is ``norm``: the smallest weighted norm of what stays
    free, or ``dot``: the largest weighted dot product of demand and free room.
    """

    tokens: int = 1024
    documents: int = 512
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must be in descending order.

    A piece goes to the open bin that meets every capacity and is best by the
    rule (the earliest on ties), else to a new bin. A piece longer than a
    capacity by itself still gets a bin of its own. Bins that cannot take the
    shortest remaining piece are closed, which changes no choice.
    """
    n = len(lengths)
    capacity = np.array([bins.tokens, bins.documents, bins.attention], float)
    weight = np.array(bins.weights) / capacity**2
    free = np.empty((3, n))
    name = np.empty(n, np.int64)
    used = np.zeros(n, np.int64)
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    shortest = lengths[-1] if n else 0
    made = opened = 0
    for i, length in enumerate(lengths):
        need = (length, 1, length * length)
        left = [free[d, :opened] - need[d] for d in range(3)]
        fits = (left[0] >= 0) & (left[1] >= 0) & (left[2] >= 0)
        at = -1
        if opened and fits.any():
            if bins.rule == "dot":
                worth = sum(weight[d] * need[d] * free[d, :opened] for d in range(3))
                at = int(np.where(fits, worth, -np.inf).argmax())
            else:
                norm = sum(weight[d] * left[d] * left[d] for d in range(3))
                at = int(np.where(fits, norm, np.inf).argmin())
        if at < 0:
            at, opened = opened, opened + 1
            free[:, at] = capacity
            name[at] = made
            made += 1
        free[:, at] -= need
        where[i], offset[i] = name[at], used[name[at]]
        used[name[at]] += length
        if free[0, at] < shortest or free[1, at] < 1 or free[2, at] < shortest * shortest:
            opened -= 1
            free[:, at : opened] = free[:, at + 1 : opened + 1]
            name[at:opened] = name[at + 1 : opened + 1]
    return where, offset


PACKED = T.StructType(
    PIECES.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
)


def pack(pieces: DataFrame, bins: Bins = Bins(), group_size: int = 4096) -> DataFrame:
    """Give each piece a sequence and a place in it: columns of ``token_pieces`` plus ``sequence_id``, ``offset``.

    Pieces are read from a written table, so that a row's place in its file
    deals it to a group whatever its values are: repeated rows are spread too.
    Full pieces are sequences by themselves. Empty input gives an empty result.
    """
    placed = materialize(pieces, "pieces")
    groups = max(1, -(-placed.where(F.col("length") < bins.tokens).count() // group_size))
    dealt = placed.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=order))
        lengths = table["length"].to_numpy()
        whole = int((lengths >= bins.tokens).sum())
        where, offset = best_fit(lengths[whole:], bins)
        base = table["_group"][0].as_py() << 32
        sequence = np.concatenate([np.arange(whole), where + whole]) + base
        return table.select(PIECES.names).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(np.concatenate([np.zeros(whole, np.int64), offset]))
        )

    return dealt.groupBy("_group").applyInArrow(run, PACKED)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, bins: Bins = Bins(), end_id: int = 2, group_size: int = 4096
) -> DataFrame:
    """Tokenise ``docs (doc_id, text)`` and pack the pieces; see ``token_pieces`` and ``pack``."""
    pieces = token_pieces(docs, vocabulary or default_vocabulary(), bins.tokens, end_id)
    return pack(pieces, bins, group_size)
