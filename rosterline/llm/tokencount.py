"""Token counts under a unigram model, by dynamic programming over a trie of pre-tokens.

Distinct pre-tokens are put into a trie in sorted order. A node holds the best score of the text up to
it and the number of tokens of that best way; the search for the node's score reads its ancestors, so
pre-tokens with a common beginning share it. Counts stand at the nodes where pre-tokens end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import table, text_pieces

MARK = "▁"
#: Pre-tokens whose counts a worker keeps between batches.
CACHE_ENTRIES = 500_000
#: Pre-tokens longer than this share the trie like all others, but a worker does not keep their counts.
KEPT_LENGTH = 64


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class UnigramCounter:
    """Number of tokens of a text under the pieces and scores of a vocabulary file.

    The scores are used as unigram scores whatever they stand for. Those of the default file are not log
    probabilities but negative merge ranks, so that the best way is the one of earliest merges in sum.

    A pre-token is the mark for a space and a word between white space. Its tokens are the pieces with
    the largest sum of scores; of equal sums the one with fewer tokens counts. A character that begins
    no usable piece is as many tokens as it has bytes, each at ``byte_score``, lower than any piece.
    """

    def __init__(self, path: str | None = None, pieces: dict[str, float] | None = None):
        if pieces is None:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path())
            size = model.get_piece_size()
            usual = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
            pieces = {model.id_to_piece(i): model.get_score(i) for i in usual}
        self.byte_score = min(pieces.values(), default=0.0) - 10.0
        #: pieces by their last character and length, so a node looks back along its own path
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        ends: dict[str, set[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-1], set()).add(len(piece))
        self.ends = {c: tuple(sorted(n)) for c, n in ends.items()}
        self.counts: dict[str, int] = {}
        self.steps = 0

    def _extend(self, word: str, i: int, best: list[float], used: list[int]) -> None:
        """Best score and count of the first ``i`` characters, from those of shorter prefixes."""
        n = len(word[i - 1].encode())
        top, count = best[i - 1] + n * self.byte_score, used[i - 1] + n
        get = self.pieces.get
        for k in self.ends.get(word[i - 1], ()):
            if k > i:
                break
            score = get(word[i - k : i])
            if score is not None:
                score += best[i - k]
                if score > top or (score == top and used[i - k] + 1 < count):
                    top, count = score, used[i - k] + 1
        best[i:] = [top]
        used[i:] = [count]
        self.steps += 1

    def count_sorted(self, words: list[str]) -> list[int]:
        """Counts of sorted distinct pre-tokens; only what follows the prefix shared with the last is computed.

        Going through sorted words is going through the trie depth first; ``best`` and ``used`` hold the
        nodes on the path from the root.
        """
        best, used, last, out = [0.0], [0], "", []
        for word in words:
            shared, most = 0, min(len(word), len(last))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            for i in range(shared + 1, len(word) + 1):
                self._extend(word, i, best, used)
            out.append(used[len(word)])
            last = word
        return out

    def texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(tokens, pre-tokens) of each text; pre-tokens the worker does not know yet make up one trie."""
        split = [t.split() for t in texts]
        fresh = set().union(*split) - self.counts.keys()
        if len(self.counts) + len(fresh) > CACHE_ENTRIES:
            self.counts.clear()
            fresh = set().union(*split)
        ordered = sorted(fresh)
        self.counts.update(zip(ordered, self.count_sorted([MARK + w for w in ordered]), strict=True))
        get = self.counts.__getitem__
        out = [(sum(map(get, words)), len(words)) for words in split]
        for w in ordered:
            if len(w) > KEPT_LENGTH:
                del self.counts[w]
        return out


@lru_cache(maxsize=1)
def counter(path: str | None) -> UnigramCounter:
    """One per worker process; Spark reuses the process for further tasks."""
    return UnigramCounter(path)


def token_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_pretokens, n_chars of every document; null and empty texts have none.

    Everything happens where the text is read: batches of text are counted against the worker's own trie,
    so nothing is shuffled and a hot word costs what a rare one does.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for piece in text_pieces(batches):
            got = count.texts(piece.column(1).to_pylist())
            columns = [pa.array([g[k] for g in got], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *columns, piece.column(2)], names=["doc_id", "n_tokens", "n_pretokens", "n_chars"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text)
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, n_pretokens long, n_chars long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
