"""SentencePiece encoding and decoding by a shared-prefix Viterbi pass.

A text is cut into marked words (a run of word marks and what follows), and these
where two characters meet that no piece holds side by side; no piece of the
vocabulary crosses a cut. The distinct words of a bounded stretch
of texts are sorted, which is the depth-first order of their trie, and walked one
after another: the forward states of the characters that a word shares with the
one before are kept, and only the rest is computed.

A forward state of a unigram model is the best score of the prefix and the last
piece that gives it. In a BPE model the arcs of the lattice are limited to pieces
that merging leaves beside the piece before; exactly one path remains for every
prefix, so the state is its last piece, and the ids equal those of merging.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from ticketmart.llm.common import map_text

MARK = "▁"
#: Texts are taken together up to about this many characters.
STRETCH = 2_000_000
_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
#: How far below the worst piece the unigram score of an unknown character lies.
_PENALTY = 10.0


class Pieces:
    """A vocabulary, read from the bytes of a model file."""

    def __init__(self, model: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is can be used")
        if proto.trainer_spec.model_type not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models can be used")
        self.merging = proto.trainer_spec.model_type == _BPE
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.ids: dict[str, int] = {}
        self.scores: list[float] = []
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        for i, piece in enumerate(proto.pieces):
            self.scores.append(piece.score)
            self.bytes_of.append(b"")
            if piece.type in (_NORMAL, _USER):
                self.ids[piece.piece] = i
                self.bytes_of[i] = piece.piece.replace(MARK, " ").encode()
            elif piece.type == _BYTE:
                value = int(piece.piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif piece.type == _UNKNOWN:
                self.unknown = i
                self.bytes_of[i] = proto.trainer_spec.unk_surface.encode()
        if not proto.trainer_spec.byte_fallback:
            self.byte_ids = {}
        normal = [self.scores[i] for i in self.ids.values()]
        self.worst = min(normal, default=0.0) - _PENALTY
        self.longest = max(map(len, self.ids), default=1)
        #: Every end of a piece with the id of the piece it is, or -1 if it is only an end.
        self.ends: dict[str, int] = {}
        #: Neighbouring characters inside pieces; no piece crosses any other place.
        self.joins: set[str] = set()
        for piece in self.ids:
            for i in range(len(piece)):
                self.ends.setdefault(piece[i:], self.ids.get(piece[i:], -1))
                self.joins.add(piece[i : i + 2])
        self._word = self._cuts()
        self._pairs: dict[int, bool] = {}
        self._names = [piece.piece for piece in proto.pieces]
        self._known: dict[str, bytes] = {}

    def _cuts(self) -> re.Pattern[str]:
        """Pattern of the words: marks, then other characters, then letters and digits.

        A word ends where it may without cutting a piece: before a mark, around a
        line end, and after letters and digits that nothing else follows in a piece.
        """
        crossed = {pair[0] for pair in self.joins if not pair[-1].isalnum()}
        solid = {c for c in "".join(self.ids) if c.isalnum()} - crossed
        if any(pair[-1] == MARK != pair[0] for pair in self.joins):
            return re.compile(r"(?s).+")
        line = "" if "\n" in "".join(self.ids) else "\n"
        end = "".join(map(re.escape, sorted(solid)))
        if not end:
            return re.compile(f"{MARK}*[^{MARK}{line}]+|{MARK}+|\n")
        return re.compile(
            f"{MARK}*[^{end}{MARK}{line}]*[{end}]+|{MARK}*[^{end}{MARK}{line}]+|{MARK}+|\n"
        )

    # -- encoding

    def words(self, text: str) -> list[str]:
        return self._word.findall(self.prefix + text.replace(" ", MARK)) if text else []

    def merged(self, text: str) -> list[str]:
        """Pieces that are left when the best neighbouring pair is merged again and again."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, at = self.scores[found], i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _beside(self, left: int, right: int) -> bool:
        """Whether merging leaves the two pieces as they are when they meet."""
        if len(self._pairs) >= 600_000:
            self._pairs.clear()
        pair = [self._names[left], self._names[right]]
        known = self._pairs[left << 32 | right] = self.merged("".join(pair)) == pair
        return known

    def parts(self, word: str) -> list[str]:
        """The word, cut wherever two characters meet that do so in no piece."""
        joins, found, at = self.joins, [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joins:
                found.append(word[at:i])
                at = i
        found.append(word[at:])
        return found

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) for words in sorted order, sharing the states of common prefixes.

        A character that no piece holds has the id -1.
        """
        # By length of the prefix: where its last piece begins, its id, the score.
        begin, last, total = [0], [-1], [0.0]
        grow = self._grow_merged if self.merging else self._grow_best
        path = ""
        for word in words:
            shared = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                shared += 1
            del begin[shared + 1 :], last[shared + 1 :], total[shared + 1 :]
            grow(word, begin, last, total)
            path = word
            ids, end = [], len(word)
            while end:
                ids.append(last[end])
                end = begin[end]
            yield word, ids[::-1]

    def _grow_merged(self, word: str, begin: list[int], last: list[int], total: list) -> None:
        ends, pairs, beside = self.ends.get, self._pairs.get, self._beside
        for end in range(len(begin), len(word) + 1):
            start = end - 1
            number = ends(word[start:end], -1)
            if number >= 0:
                while True:
                    before = last[start]
                    if number >= 0 and before >= 0:
                        known = pairs(before << 32 | number)
                        if known or (known is None and beside(before, number)):
                            break
                    elif number >= 0:
                        break
                    start -= 1
                    number = ends(word[start:end], -1)
            begin.append(start)
            last.append(number)

    def _grow_best(self, word: str, begin: list[int], last: list[int], total: list) -> None:
        ends, scores, longest = self.ends.get, self.scores, self.longest
        for end in range(len(begin), len(word) + 1):
            begin.append(end - 1)
            last.append(ends(word[end - 1 : end], -1))
            best = total[end - 1] + (self.worst if last[end] < 0 else scores[last[end]])
            for start in range(end - 2, max(-1, end - 1 - longest), -1):
                number = ends(word[start:end])
                if number is None:
                    break
                if number >= 0 and total[start] + scores[number] > best:
                    best = total[start] + scores[number]
                    begin[end], last[end] = start, number
            total.append(best)

    def _numbers(self, word: str, ids: list[int]) -> bytes:
        if min(ids) < 0:  # unknown characters stand for themselves, so lengths tell the places
            found, at = [], 0
            for number in ids:
                if number >= 0:
                    found.append(number)
                    at += len(self._names[number])
                    continue
                if self.byte_ids:
                    raw = word[at].encode("utf-8", "replace")
                    found.extend(map(self.byte_ids.__getitem__, raw))
                else:
                    found.append(self.unknown)
                at += 1
            ids = found
        return np.array(ids, "<i4").tobytes()

    def _codes(self, words: set[str]) -> dict[str, bytes]:
        """Ids of distinct words; those of shorter parts are remembered."""
        if len(self._known) >= 600_000:
            self._known.clear()
        known = self._known
        codes = {word: known[word] for word in words if word in known}
        cut = {word: self.parts(word) for word in words if word not in codes}
        fresh = set(chain.from_iterable(cut.values()))
        ids = {part: known[part] for part in fresh if part in known}
        for part, numbers in self.walk(sorted(fresh - ids.keys())):
            ids[part] = self._numbers(part, numbers)
            if len(part) <= 64:
                known[part] = ids[part]
        for word, parts in cut.items():
            codes[word] = b"".join(map(ids.__getitem__, parts))
        return codes

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray | None]:
        """Ids of each text; none for a null text, an empty array for an empty one."""
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size < STRETCH):
                size += len(texts[end] or "")
                end += 1
            cut = [None if text is None else self.words(text) for text in texts[at:end]]
            codes = self._codes(set(chain.from_iterable(words for words in cut if words)))
            for words in cut:
                if words is None:
                    yield None
                else:
                    yield np.frombuffer(b"".join(map(codes.__getitem__, words)), "<i4")
            at = end

    # -- decoding

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_LOADED: dict[int, Pieces] = {}


def _pieces(key: int, model: bytes) -> Pieces:
    """The vocabulary, read once in every worker process."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if a is None else len(a) for a in arrays]
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = np.concatenate([a for a in arrays if a is not None] or [np.empty(0, np.int32)])
    mask = pa.array([a is None for a in arrays], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=mask)


def read_model(path: str) -> bytes:
    """A model file from the driver's disk; it has a fixed size, half a megabyte say."""
    with open(path, "rb") as file:
        return file.read()


def with_ids(
    docs: DataFrame, model: bytes, text: str = "text", ids: str = "ids", same: str = "round_trip"
) -> DataFrame:
    """Adds the ids of a text column, and whether decoding them gives the text again.

    A null text has null for both; an empty one has no ids and is its own round
    trip. Texts are encoded whole, and characters outside the vocabulary become
    their bytes. A text that itself holds the word mark does not come back, as
    the mark decodes to a blank. Every other column stays as it is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = hash(model)

    def work(texts: list[str | None]) -> list[pa.Array]:
        pieces = _pieces(key, shared.value)
        arrays = list(pieces.encode(texts))
        again = [
            None if found is None else pieces.decode(found.tolist()) == value
            for value, found in zip(texts, arrays, strict=True)
        ]
        return [_lists(arrays), pa.array(again, pa.bool_())]

    return map_text(docs, text, f"`{ids}` array<int>, `{same}` boolean", work)


def with_text(rows: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text that a column of ids stands for; null stays null."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    key = hash(model)

    def work(lists: list[list[int] | None]) -> list[pa.Array]:
        pieces = _pieces(key, shared.value)
        texts = [None if found is None else pieces.decode(found) for found in lists]
        return [pa.array(texts, pa.string())]

    return map_text(rows, ids, f"`{text}` string", work)


def encoded(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document: doc_id, ids, n_ids, round_trip."""
    chosen = docs.select(F.col("doc_id"), F.col("text"))
    return with_ids(chosen, model).select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip")
