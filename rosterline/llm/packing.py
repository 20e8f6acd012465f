"""Vector bin packing of examples into training sequences.

An example takes up tokens, one segment and loss-bearing tokens at once. Whole sequences are cut
from long examples on the spot; only the remainders are packed, each batch of them by the
dot-product heuristic. Rows that travel hold lengths and checksums, never token ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import kept, table, text_pieces, tidy

SEQUENCE_TOKENS = 1024
MAX_SEGMENTS = 64
#: Examples that are packed together; a packing loses about one sequence in so many examples.
PACK_ROWS = 40_000
#: Distinct words whose ids a worker keeps.
CACHE_ENTRIES = 600_000


def tokenizer_path() -> str:
    """Default vocabulary file; found on the worker, where it is installed too."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Uneven(Exception):
    """White space before a space: the pieces between spaces are not independent."""


class _Known(dict):
    """Ids of a space and what follows it up to the next space.

    No pre-token crosses a space that follows other than white space, so these pieces can be encoded
    one by one. Long ones are not kept.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace():
            raise _Uneven
        got = self.encode(" " + piece)
        if len(piece) <= 48:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = got
        return got


class BpeBytes:
    """Ids of texts as little-endian unsigned 32-bit strings, as the vocabulary file itself gives them.

    Words repeat, so each is encoded once per worker and looked up after that. The cache is emptied
    when full. A text that holds the string of a special token goes to the file's own library whole, which
    gives the token's id for it.
    """

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path or tokenizer_path())
        self.special = [token.content for token in self.encoder.get_added_tokens_decoder().values()]
        self.fast = self._ranks(path or tokenizer_path())
        self.known = _Known(self._ids)

    @staticmethod
    def _ranks(path: str):
        """The same merges in the faster library, taken from the json file itself; None if it is of another kind."""
        import json

        import tiktoken
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            found = json.load(f)
        model = found["model"]
        if model["type"] != "BPE" or (found.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            return None
        if found["pre_tokenizer"].get("add_prefix_space") or found.get("normalizer"):
            return None
        special = {x["content"] for x in found.get("added_tokens", [])}
        # the printable stand-ins of the 256 bytes: those that print stand for themselves, others follow from 256 on
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(own)]
        of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        assert set(of) == set(ByteLevel.alphabet())
        ranks = {bytes(of[c] for c in piece): i for piece, i in model["vocab"].items() if piece not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("json", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _own(self, text: str) -> bytes:
        return np.asarray(self.encoder.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        if self.fast is None:
            return self._own(text)
        return np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.special):
            return self._own(text)
        first, *rest = text.split(" ")
        if self.fast is None or not rest:
            return self._ids(text)
        last = rest.pop()
        try:
            return b"".join([self._ids(first), *map(self.known.__getitem__, rest), self._ids(" " + last)])
        except _Uneven:
            return self._ids(text)


def encoder(path: str | None) -> BpeBytes:
    """One per worker process; Spark reuses the process for further tasks, and the next operator there lets it go."""
    return kept((__name__, path), lambda: BpeBytes(path))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long"


def cut_pieces(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokens: int = SEQUENCE_TOKENS, path: str | None = None) -> DataFrame:
    """Pieces of every document: full sequences from its start, then the remainder.

    A null text counts as empty; the end id 0 makes that one token. The end id bears no loss.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for piece in text_pieces(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                ids = encode(text) + b"\0\0\0\0"
                n = len(ids) // 4
                for start in range(0, n, tokens):
                    part = ids[4 * start : 4 * (start + tokens)]
                    size = len(part) // 4
                    row = (doc, start, size, zlib.crc32(part), n, size - (start + size == n))
                    for held, value in zip(out, row, strict=True):
                        held.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text).mapInArrow(tidy(run, (__name__, path)), PIECES)


def dot_product_bins(sizes: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and order in the bin of every row of ``sizes`` (rows x dimensions) under ``limits``.

    One bin is open at a time. Of the remaining kinds of items (rows with equal sizes) that fit in
    every dimension, the one with the largest dot product of its sizes and the bin's free room, both
    as shares of the limits and weighted by how scarce each dimension is overall, goes in next.
    """
    n = len(sizes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds, of = np.unique(sizes, axis=0, return_inverse=True)
    of = of.reshape(-1)
    rows = np.argsort(of, kind="stable")
    left = np.bincount(of, minlength=len(kinds))
    at = np.concatenate(([0], np.cumsum(left)[:-1]))
    share = kinds / limits
    weight = share.T @ left
    weight = weight / max(weight.sum(), 1e-12)
    scored = share * weight
    bins, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = np.arange(len(kinds))
    done, current = 0, 0
    while done < n:
        room = limits.astype(np.int64).copy()
        k = 0
        while True:
            fits = live[(left[live] > 0) & (kinds[live] <= room).all(axis=1)]
            if not len(fits):
                break
            best = fits[np.argmax(scored[fits] @ (room / limits))]
            row = rows[at[best]]
            at[best] += 1
            left[best] -= 1
            bins[row], place[row] = current, k
            room = room - kinds[best]
            k += 1
            done += 1
        if not k:
            raise ValueError("an item is larger than a bin")
        current += 1
        if current % 64 == 0:
            live = live[left[live] > 0]
    return bins, place


PLACES = "sequence_id long, offset long, segment long"


def pack(pieces: DataFrame, tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss: int | None = None, rows: int = PACK_ROWS, keys: list[str] | None = None) -> DataFrame:
    """Sequence and offset of every piece (length, loss_tokens), within ``tokens``, ``segments`` and ``loss`` per sequence.

    Pieces are dealt by a hash of ``keys`` (document and start) into batches of about ``rows``; every batch is
    packed on its own. The sequence number holds the task's number in its upper bits.
    """
    keys = keys or ["doc_id", "start"]
    limits = np.array([tokens, segments, loss or tokens], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 36
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> pa.RecordBatch:
            nonlocal base
            got = pa.Table.from_batches(held).combine_chunks()
            length = got.column("length").to_numpy()
            sizes = np.stack([length, np.ones_like(length), got.column("loss_tokens").to_numpy()], axis=1)
            bins, place = dot_product_bins(sizes, limits)
            order = np.lexsort((place, bins))
            ends = np.cumsum(length[order])
            begin = ends - length[order]
            first = np.concatenate(([True], bins[order][1:] != bins[order][:-1]))
            origin = np.maximum.accumulate(np.where(first, begin, 0))
            offset = np.empty_like(length)
            offset[order] = begin - origin
            for name, column in (("sequence_id", bins + base), ("offset", offset), ("segment", place)):
                got = got.append_column(name, pa.array(column, pa.int64()))
            base += int(bins.max()) + 1
            return got.combine_chunks().to_batches()[0]

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= rows:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    dealt = pieces.repartition(F.xxhash64(*keys)).sortWithinPartitions(*keys, "ids_crc32")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.mapInArrow(run, f"{fields}, {PLACES}")


def pack_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss: int | None = None, path: str | None = None) -> DataFrame:
    """All documents in sequences of at most ``tokens``, ``segments`` and ``loss`` (as many as tokens where none); one row per piece.

    All ids of a document but its end id bear loss, so a lower ``loss`` cuts pieces of that many tokens. Null texts
    count as empty and give one token. Equal rows are packed as often as they occur. Extra columns of ``docs`` are
    left out. No documents give no rows.
    """
    got = pack(cut_pieces(docs, id_column, text_column, min(tokens, loss or tokens), path), tokens, segments, loss)
    return got.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "segment", "loss_tokens")


EXAMPLES = "conv_id long, turn long, start long, length long, ids_crc32 long, example_tokens long, loss_tokens long"


def cut_turns(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", learned: str = "assistant", tokens: int = SEQUENCE_TOKENS, path: str | None = None) -> DataFrame:
    """Pieces of instruction data: the ids of a turn and an end id; only turns whose role is ``learned`` bear loss, end id included.

    A null text counts as empty, a null role bears no loss. Pieces hold ``tokens`` at most.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    bears = F.coalesce(F.col(role_column) == F.lit(learned), F.lit(False)).alias("bears")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for piece in text_pieces(batches):
            out: list[list] = [[], [], [], [], [], [], []]
            for conversation, text, turn, own in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                ids = encode(text) + b"\0\0\0\0"
                n = len(ids) // 4
                for start in range(0, n, tokens):
                    part = ids[4 * start : 4 * (start + tokens)]
                    size = len(part) // 4
                    for held, value in zip(out, (conversation, turn, start, size, zlib.crc32(part), n, size * own), strict=True):
                        held.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=[c.split()[0] for c in EXAMPLES.split(", ")])

    rows = conversations.select(F.col(id_column).cast("long").alias("conv_id"), text, F.col(turn_column).cast("long").alias("turn"), bears)
    return rows.mapInArrow(tidy(run, (__name__, path)), EXAMPLES)


def pack_conversations(conversations: DataFrame, tokens: int = SEQUENCE_TOKENS, segments: int = MAX_SEGMENTS, loss: int = SEQUENCE_TOKENS // 2, path: str | None = None, **columns: str) -> DataFrame:
    """Turns of instruction data in sequences under all three limits; here ``loss`` binds, as only some turns bear it.

    Pieces are cut to ``loss`` tokens, so that none exceeds a limit by itself. One row per piece.
    """
    pieces = cut_turns(conversations, tokens=min(tokens, loss), path=path, **columns)
    return pack(pieces, tokens, segments, loss, keys=["conv_id", "turn", "start"])


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
