"""Token counts by count-only Viterbi over a unigram vocabulary.

The vocabulary is a list of pieces with scores; a piece that begins a word carries the word mark. A text is cut into
words at white space, each word is preceded by the mark, and no piece goes beyond a word, so the best segmentation of a
text is that of its words. Per distinct word an Aho-Corasick automaton enumerates all vocabulary pieces in it; dynamic
programming over end positions keeps the best score and its piece count only, no paths.

Tie rules of the exact tokenizer: at an end position the first candidate in order of starts (the longest last piece)
stays unless a later one scores strictly higher. A character that is no piece by itself may be unknown: it scores the
lowest piece's score less 10, and counts as its UTF-8 bytes when the vocabulary has byte pieces, else as one piece for
each run of unknown characters.

Defined results: a null, empty or blank text has 0 pieces and score 0. Scores are sums in double precision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_batch, read_table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Entries that each of a task's two caches keeps before it starts anew.
CACHE_WORDS = 100_000


def load_pieces(model_file: str) -> list[tuple[str, float]]:
    """(piece, score) of a public vocabulary file, control and byte pieces left out: a word's pieces only."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(m.get_piece_size())
    return [(m.id_to_piece(i), m.get_score(i)) for i in ids if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], byte_pieces: bool = True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        lowest = 0.0
        for piece, score in pieces:
            lowest = min(lowest, score)
            if MARK in piece[1:]:
                continue  # spans words
            if len(piece) == 1:
                self.single.add(piece)
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = lowest - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        #: Neighbours inside some piece. Between other neighbours no piece can lie across, so a word is cut there.
        self.joined = {p[i : i + 2] for p, _ in pieces if MARK not in p[1:] for i in range(len(p) - 1)}
        self.cache: dict[bytes, tuple[int, float]] = {}
        self.parts: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of MARK + word: that of its parts, added up."""
        text, joined, single = MARK + word, self.joined, self.single
        pieces, score, begin = 0, 0.0, 0
        for k in range(1, len(text) + 1):
            if k < len(text) and (text[k - 1 : k + 1] in joined or (text[k - 1] not in single and text[k] not in single)):
                continue
            part = text[begin:k]
            got = self.parts.get(part)
            if got is None:
                if len(self.parts) >= CACHE_WORDS:
                    self.parts.clear()
                got = self.parts[part] = self.part(part)
            pieces, score, begin = pieces + got[0], score + got[1], k
        return pieces, score

    def part(self, text: str) -> tuple[int, float]:
        n, single, unknown = len(text), self.single, self.unknown
        score: list = [0.0] + [None] * n
        start, count, tail = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)  # tail: the last piece is unknown
        done = 0

        def finish(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                c, best = text[done - 1], score[done]
                if c not in single and (best is None or score[done - 1] + unknown > best):
                    score[done], tail[done] = score[done - 1] + unknown, True
                    more = len(c.encode("utf-8", "replace")) if self.byte_pieces else int(not tail[done - 1])
                    count[done] = count[done - 1] + more
                else:
                    count[done] = count[start[done]] + 1

        for last, (length, s) in self.automaton.iter(text):  # by ascending end
            finish(last)
            end, begin = last + 1, last + 1 - length
            at, best = score[begin] + s, score[end]
            if best is None or at > best or (at == best and begin < start[end]):
                score[end], start[end] = at, begin
        finish(n)
        return count[n], score[n]

    def text(self, text: str | None) -> tuple[int, float, int]:
        """(pieces, score, words)."""
        cache, pieces, score = self.cache, 0, 0.0
        words = (text or "").encode("utf-8", "replace").split()
        for word in words:
            got = cache.get(word)
            if got is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                got = cache[word] = self.word(word.decode())
            pieces += got[0]
            score += got[1]
        return pieces, score, len(words)


def token_counts(docs: DataFrame, model_file: str, byte_pieces: bool = True) -> DataFrame:
    """(doc_id, n_words, n_tokens, score) for every row of docs(doc_id, text); other columns are ignored."""

    def start():
        counter = Counter(load_pieces(model_file), byte_pieces)

        def work(doc_ids, texts):
            found = [counter.text(t) for t in texts]
            return [doc_ids, [x[2] for x in found], [x[0] for x in found], [x[1] for x in found]]

        return work

    return by_batch(docs, ["doc_id", "text"], "doc_id long, n_words long, n_tokens long, score double", start)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Pieces of every whole document; the vocabulary is that of a public tokenizer file, read as a unigram model."""
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).withColumn(
        "tokens_a_word", F.when(F.col("n_words") > 0, F.col("n_tokens") / F.col("n_words"))
    )
