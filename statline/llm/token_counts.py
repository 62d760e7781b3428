"""Token counts of a unigram vocabulary without the tokens: Viterbi over the matches of an Aho-Corasick automaton."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from statline.llm.common import texts_of

# Fixed values of unigram tokenizers: the mark of a blank, and how far below the least score an unknown character counts.
BLANK, UNKNOWN_PENALTY = "▁", 10.0


def piece_scores(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, the unknown piece first, control pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    return [(model.id_to_piece(model.unk_id()), model.get_score(model.unk_id()))] + [
        (model.id_to_piece(i), model.get_score(i)) for i in ids]


class PieceCounter:
    """``(pieces, score)`` of the best segmentation of a text under a unigram vocabulary with byte fallback.

    The score of a path is the sum of its pieces' scores. Of equal paths into a place, the one whose last piece starts
    first wins. A character that is no piece may be crossed at the least score less ten and then counts one piece a byte.
    Blanks are written as their mark and a text gets one in front unless it starts with one. Because no piece has a blank
    after another character, a text is cut before every run of blanks, and each distinct part is worked out once.
    """

    def __init__(self, pieces: list[tuple[str, float]], most: int = 500_000):
        if any(BLANK in p.lstrip(BLANK) for p, _ in pieces):
            raise ValueError("a piece has a blank after another character; texts cannot be cut before blanks")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = frozenset(p for p, _ in pieces if len(p) == 1)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}
        self.most = most

    def part(self, text: str) -> tuple[int, float]:
        n = len(text)
        score: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        single, unknown, ready = self.single, self.unknown, 0
        for last, (length, value) in self.automaton.iter(text):
            end = last + 1
            while ready < end - 1:  # every earlier place gets its crossing before it is left from
                ready += 1
                self._cross(text, ready, score, count)
            start = end - length
            candidate = score[start] + value
            if score[end] is None or candidate > score[end]:
                score[end], count[end] = candidate, count[start] + 1
        while ready < n:
            ready += 1
            self._cross(text, ready, score, count)
        return count[n], score[n]

    def _cross(self, text, end, score, count) -> None:
        char = text[end - 1]
        if char not in self.single:
            candidate = score[end - 1] + self.unknown
            if score[end] is None or candidate > score[end]:
                score[end], count[end] = candidate, count[end - 1] + len(char.encode("utf-8", "surrogatepass"))

    def __call__(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", BLANK)
        if text[0] != BLANK:
            text = BLANK + text
        parts = self._parts.findall(text)
        known, pieces, score = self.known, 0, 0.0
        for part in parts:
            found = known.get(part)
            if found is None:
                if len(known) >= self.most:
                    known.clear()
                found = known[part] = self.part(part)
            pieces += found[0]
            score += found[1]
        return pieces, score

    _parts = re.compile(f"{BLANK}+[^{BLANK}]*")


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, n_bytes, n_tokens, score`` of every whole text; a null or empty text has no tokens and score 0."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PieceCounter(piece_scores(model_path))
        for batch in batches:
            texts = batch["text"].tolist()
            found = [counter(t) for t in texts]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n_chars": [len(t) for t in texts],
                "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                "n_tokens": [n for n, _ in found], "score": [s for _, s in found]})

    return texts_of(docs, id_col, text_col).mapInPandas(
        count, "doc_id long, n_chars long, n_bytes long, n_tokens long, score double")
