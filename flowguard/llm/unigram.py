"""A unigram piece model: best segmentation by Viterbi over Aho-Corasick matches.

Vocabulary and scores come from a SentencePiece model file; text is prepared the
SentencePiece way (space as U+2581, one such prefix, nothing else changed) and
segmented by the unigram model with the rules of that library: a character that is
no piece itself may be an unknown piece of the least score less 10, an unknown
piece is written as its UTF-8 bytes, and among equally good pieces that end at one
place the one that starts first wins. Scores are summed exactly (the library sums in
32 bits, which rounds in long texts).
"""

from __future__ import annotations

import re
from array import array
from typing import NamedTuple

import numpy as np

SPACE = "▁"
_LEAST = float("-inf")


class Vocabulary(NamedTuple):
    """What tasks need of a model: bounded by the vocabulary, so it can be sent to all."""
    pieces: list[str]           # by id; "" where the id is no ordinary piece
    scores: list[float]
    byte_ids: list[int]         # id of the piece that stands for each byte
    surface: list[bytes]        # what decoding an id writes


def read_vocabulary(model_path: str) -> Vocabulary:
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces, scores, surface, byte_ids = [], [], [], [sp.unk_id()] * 256
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        plain = not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        else:
            surface.append(piece.replace(SPACE, " ").encode("utf-8") if plain else b"")
        pieces.append(piece if plain else "")
        scores.append(sp.get_score(i))
    return Vocabulary(pieces, scores, byte_ids, surface)


def prepare(text: str | None) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


class Unigram:
    """Segmentation with one vocabulary; made once per task."""

    def __init__(self, vocabulary: Vocabulary, cached: int = 300_000):
        import ahocorasick
        self.v = vocabulary
        self.auto = ahocorasick.Automaton()
        self.single = set()
        self.longest = 1
        for i, piece in enumerate(vocabulary.pieces):
            if piece:
                self.auto.add_word(piece, (len(piece), vocabulary.scores[i], i))
                self.longest = max(self.longest, len(piece))
                if len(piece) == 1:
                    self.single.add(piece)
        self.auto.make_automaton()
        plain = [s for p, s in zip(vocabulary.pieces, vocabulary.scores) if p]
        self.unknown = float(np.float32(min(plain)) - np.float32(10))
        # where no piece has a space sign after another character, the best path has
        # a node before every run of space signs, and the parts are independent
        self.parts = None
        if not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in vocabulary.pieces):
            self.parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.cached = cached
        self._counts: dict[str, int] = {}
        self._ids: dict[str, tuple] = {}
        self._packed: dict[str, bytes] = {}
        self._spell: dict[str, list[int]] = {}

    def matches(self, text: str):
        """(end, start, score, id) of pieces and unknown characters by end, then start."""
        single = self.single
        at = 0
        for last, (n, score, i) in self.auto.iter(text):
            while at < last:
                if text[at] not in single:
                    yield at + 1, at, self.unknown, -1
                at += 1
            yield last + 1, last + 1 - n, score, i
        while at < len(text):
            if text[at] not in single:
                yield at + 1, at, self.unknown, -1
            at += 1

    def spelled(self, char: str) -> list[int]:
        got = self._spell.get(char)
        if got is None:
            got = self._spell[char] = [self.v.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]
        return got

    # -- counts only ---------------------------------------------------------
    def _count_part(self, text: str) -> int:
        """Best score and number of pieces are carried for the last few places only."""
        ring = self.longest + 1
        score, count = [_LEAST] * ring, [0] * ring
        score[0] = 0.0
        if self._known(text):
            return self._count_known(text, ring, score, count)
        now = 0
        for end, start, s, i in self.matches(text):
            if end != now:
                score[end % ring] = _LEAST
                now = end
            total = score[start % ring] + s
            if total > score[end % ring]:
                score[end % ring] = total
                count[end % ring] = count[start % ring] + (1 if i >= 0 else len(self.spelled(text[start])))
        return count[len(text) % ring]

    def _count_known(self, text: str, ring: int, score: list[float], count: list[int]) -> int:
        """The same in a plain loop where every character is known."""
        now = 0
        for last, (n, s, _) in self.auto.iter(text):
            end = last + 1
            at, start = end % ring, (end - n) % ring
            if end != now:
                score[at] = _LEAST
                now = end
            total = score[start] + s
            if total > score[at]:
                score[at], count[at] = total, count[start] + 1
        return count[len(text) % ring]

    def count(self, text: str | None) -> int:
        text = prepare(text)
        if self.parts is None:
            return self._count_part(text) if text else 0
        known, total = self._counts, 0
        for part in self.parts.findall(text):
            n = known.get(part)
            if n is None:
                n = self._count_part(part)
                if len(part) <= 64:
                    if len(known) >= self.cached:
                        known.clear()
                    known[part] = n
            total += n
        return total

    # -- paths -----------------------------------------------------------------
    def forward(self, text: str, entry: dict[int, float]) -> tuple[list[float], list]:
        """Best score at every place of ``text`` and the piece that reaches it, from
        entry places with given scores (an entry counts as the earliest start)."""
        best = [_LEAST] * (len(text) + 1)
        back: list = [None] * (len(text) + 1)
        for at, s in entry.items():
            best[at] = s
        for end, start, s, i in self.matches(text):
            total = best[start] + s
            if total > best[end]:
                best[end], back[end] = total, (start, i)
        return best, back

    def trace(self, text: str, back: list, at: int) -> tuple[list[int], int]:
        """Ids of the best path to ``at`` and the entry place where it begins."""
        out: list[list[int]] = []
        while back[at] is not None:
            start, i = back[at]
            out.append([i] if i >= 0 else self.spelled(text[start]))
            at = start
        return [i for piece in reversed(out) for i in piece], at

    def part_path(self, part: str) -> tuple[tuple[int, ...], float]:
        got = self._ids.get(part)
        if got is None:
            best, back = self.forward(part, {0: 0.0})
            got = (tuple(self.trace(part, back, len(part))[0]), best[len(part)])
            if len(part) <= 64:
                if len(self._ids) >= self.cached:
                    self._ids.clear()
                self._ids[part] = got
        return got

    def prepared_path(self, text: str) -> tuple[list[int], float]:
        ids: list[int] = []
        total = 0.0
        for part in (self.parts.findall(text) if self.parts else [text] if text else []):
            got, s = self.part_path(part)
            ids += got
            total += s
        return ids, total

    def _known(self, text: str) -> bool:
        """Whether every character is a piece, so that no unknown piece is needed."""
        return self.single.issuperset(text)

    def _part_ids(self, part: str) -> list[int]:
        """Ids of the best path over a part; a plain loop where every character is known."""
        n = len(part)
        if not self._known(part):
            _, back = self.forward(part, {0: 0.0})
            return self.trace(part, back, n)[0]
        best = [_LEAST] * (n + 1)
        best[0] = 0.0
        back: list = [None] * (n + 1)
        for last, piece in self.auto.iter(part):
            total = best[last + 1 - piece[0]] + piece[1]
            if total > best[last + 1]:
                best[last + 1] = total
                back[last + 1] = piece
        out = []
        while n:
            size, _, i = back[n]
            out.append(i)
            n -= size
        out.reverse()
        return out

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of the best path as 32-bit little-endian integers."""
        text = prepare(text)
        known, out = self._packed, []
        for part in (self.parts.findall(text) if self.parts else [text] if text else []):
            got = known.get(part)
            if got is None:
                got = array("i", self._part_ids(part)).tobytes()
                if len(part) <= 64:
                    if len(known) >= self.cached:
                        known.clear()
                    known[part] = got
            out.append(got)
        return b"".join(out)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<i4").tolist()


def decode(surface: list[bytes], ids) -> str:
    """The text of ids: surfaces joined, without the prefix space; bytes that are no
    UTF-8 become U+FFFD."""
    out = b"".join(map(surface.__getitem__, ids))
    return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")
