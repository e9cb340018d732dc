"""Unigram token counts by forward scores shared along a trie of pre-tokens."""

from __future__ import annotations

import math

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.common import documents, map_batches

PIECES = "piece_bpe_32k.model"
MARK = "▁"  # fixed value: stands before each word in the piece files
SHIFT = 2.7  # of the rank in the scores
CACHE_WORDS = 400_000  # pre-tokens whose counts a task keeps; then it starts anew


class Unigram:
    """Pieces with log scores from their rank: the file has an order, no frequencies, so a
    piece of rank r scores -ln(r + 2.7). A character outside all pieces is as many byte
    tokens as it has bytes, each with the score of the last rank."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.scores = {p: -math.log(r + SHIFT) for r, p in enumerate(names)}
        self.longest = max(map(len, names))
        self.byte_score = -math.log(len(names) + SHIFT)
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Store the token count of each pre-token.

        Sorted pre-tokens are a trie walked depth first: what a pre-token shares with the
        one before is the trie path down to their branch, whose forward scores stay on
        the stack. So each trie node is scored once. Of equal scores the fewer tokens win.
        """
        scores, longest, byte_score = self.scores, self.longest, self.byte_score
        best, counts, last = [0.0], [0], ""
        for word in sorted(words):
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                extra = len(word[end - 1].encode())
                top, fewest = best[end - 1] + extra * byte_score, counts[end - 1] + extra
                for start in range(max(0, end - longest), end):
                    score = scores.get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or (score == top and counts[start] + 1 < fewest):
                            top, fewest = score, counts[start] + 1
                best.append(top)
                counts.append(fewest)
            self.known[word] = counts[len(word)]
            last = word

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of each text."""
        words = [[MARK + w for w in (t or "").split()] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        self.learn(list({w for text in words for w in text} - self.known.keys()))
        return [(len(text), sum(map(self.known.__getitem__, text))) for text in words]


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Rows (id, ``n_words``, ``n_tokens``): tokens of the best unigram segmentation.

    Pre-tokens are the words between white space, marked at their start. Null and empty
    texts have 0 of both. Each task scores its distinct pre-tokens only; rows are
    independent of each other, and there is no shuffle.
    """
    path = path or public_tokenizers.path(PIECES)

    def run(batches):
        model = Unigram(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 1000):
                found = model.count(texts[at : at + 1000])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(found)),
                        pa.array([w for w, _ in found], pa.int64()),
                        pa.array([n for _, n in found], pa.int64()),
                    ],
                    names=["id", "n_words", "n_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = map_batches(docs.select(id_col, text_col), run, f"id {kind}, n_words long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_words", "n_tokens")


def token_counts_query(spark, folder: str) -> DataFrame:
    """Token counts of every document of ``documents``."""
    return token_counts(documents(spark, folder))
