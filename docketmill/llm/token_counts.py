"""Token counts of a unigram tokenizer without making its tokens.

Method: an Aho-Corasick automaton over the vocabulary enumerates every match in a chunk; dynamic
programming over its characters carries the best score and the number of pieces that give it. Ties go
to the candidate whose piece starts first, as in the reference Viterbi of unigram tokenizers: starts
are tried from left to right, and a later one must be strictly better. A character that is no piece of
its own may be an unknown of score `min(scores) - 10`; neighbouring unknowns fuse, and with byte
fallback an unknown counts one piece for each of its UTF-8 bytes.

Words are counted once per distinct marked word: no piece crosses a marker or a line feed.
Scores are compared in double precision. Whole-numbered scores, such as ranks, keep sums exact, so a
word's best path does not depend on the words before it; with fractional ones the count of a text is
that of its words, each scored from zero.

Cases: null text counts as empty, an empty text has no tokens; repeated rows give repeated rows; an
empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunked, words

MARK = "▁"


class Viterbi:
    """Best score and piece count of a string under a unigram vocabulary."""

    def __init__(self, vocab: list[tuple[str, float]], byte_fallback: bool = True):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        self.single = set()
        for piece, score in vocab:
            if piece:
                self.auto.add_word(piece, (len(piece), score))
                if len(piece) == 1:
                    self.single.add(piece)
        self.auto.make_automaton()
        self.unknown = min(score for _, score in vocab) - 10.0
        self.byte_fallback = byte_fallback

    def count(self, text: str) -> int:
        """Pieces on the best path."""
        n = len(text)
        starts: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, (size, score) in self.auto.iter(text):
            starts[end + 1].append((end + 1 - size, score))
        # Best score up to each character, pieces on that path, and whether its last piece is unknown.
        best, pieces, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            # Earlier starts first: on a tie the piece that starts first stays.
            top, here, unk = None, 0, False
            for start, score in sorted(starts[end]):
                total = best[start] + score
                if top is None or total > top:
                    top, here, unk = total, pieces[start] + 1, False
            c = text[end - 1]
            if c not in self.single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    size = len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else not open_[end - 1]
                    top, here, unk = total, pieces[end - 1] + size, True
            best[end], pieces[end], open_[end] = top, here, unk
        return pieces[n]


@lru_cache(maxsize=2)
def vocabulary(model: str) -> tuple[tuple[str, float], ...]:
    """The text pieces of a SentencePiece file with their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return tuple((sp.id_to_piece(i), float(sp.get_score(i))) for i in ids)


@lru_cache(maxsize=2)
def counter(model: str) -> Chunked:
    machine = Viterbi(list(vocabulary(model)))

    def marked(chunk: str) -> int | None:
        if chunk[:1] == "\n":
            return machine.count(chunk)
        return machine.count(MARK + chunk) if chunk and not chunk.endswith(MARK) else None

    def whole(text: str) -> int:
        return machine.count(MARK + text.replace(" ", MARK)) if text else 0

    return Chunked(words, lambda chunks: [marked(c) for c in chunks], whole)


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(model)
        for batch in batches:
            offsets, numbers, values = table.values(batch.column(1))
            each = np.array([0 if v is None else v for v in values], np.int64)[numbers.to_numpy()]
            odd = np.array([v is None for v in values], bool)[numbers.to_numpy()]
            counts, whole = (np.diff(np.concatenate([[0], np.cumsum(x)])[offsets]) for x in (each, odd))
            whole = np.flatnonzero(whole)
            counts[whole] = [table.whole(t) for t in batch.column(1).take(pa.array(whole)).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")
