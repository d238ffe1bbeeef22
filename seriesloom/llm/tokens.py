"""Token ids of many texts by a public tokenizer, with words already seen kept in each worker.

Both vocabularies split a text into pieces before they merge, and no piece reaches over the place
where a run of spaces begins. So a text is cut there, and each different part is encoded once.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from public_tokenizers import path
from tokenizers import Tokenizer, pre_tokenizers

# A worker keeps its encoders, and what they hold stays beside all later stages of its executor.
MOST_PARTS = 250_000  # words that a worker keeps for good, the first it meets twice
PASSING_PARTS = 150_000  # words met once, kept until there are so many
MOST_BYTE_PARTS = 800_000  # other parts that a worker keeps for good, the first it meets
PASSING_BYTE_PARTS = 200_000  # later ones, kept until there are so many
MOST_TAILS = 10_000  # runs of punctuation that a worker keeps
_MARK = "\x01"
_CUTS = re.compile(r"(?<=\S)(?= )")
#: White space other than space and line feed. (fixed values: Unicode's White_Space and four controls)
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII without the apostrophe, which may begin a piece of its own
_LAST_LATIN = "\u024f"
_ASCII_SPACE = "".join(c for c in _OTHER_SPACE if c.isascii())
_encoders: dict[str, "Encoder"] = {}


def encoder(name: str) -> "Encoder":
    """The encoder of this worker for a vocabulary file, kept between tasks."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(name) if name.startswith("word_") else ByteEncoder(name)
    return _encoders[name]


class Parts(dict):
    """Ids of parts, kept for good once they were met in two calls; those met in one so far are found in ``passing``."""

    def __init__(self):
        super().__init__()
        self.passing: dict = {}

    def __missing__(self, part):
        return self.passing[part]

    def add(self, found: dict, wanted: list) -> None:
        """Keep ``found``, which is new; ``wanted`` are passing parts that came again and are still needed."""
        if len(self) < MOST_PARTS:
            self.update((p, self.passing.pop(p)) for p in wanted)
            wanted = ()
        if len(self.passing) > PASSING_PARTS:
            self.passing = {p: self.passing[p] for p in wanted}
        self.passing.update(found)


class Met(Parts):
    """Parts that ``one`` encodes as they are met; those it has no way for wait to be learnt together."""

    def __init__(self, one):
        super().__init__()
        self.one, self.waiting = one, set()

    def __missing__(self, part):
        ids = self.passing.get(part)
        if ids is None:
            ids = self.one(part)
            if ids is None:
                self.waiting.add(part)
                return b""
            self.keep(part, ids)
        return ids

    def have(self, part) -> bytes | None:
        return self.get(part) or self.passing.get(part)

    def keep(self, part, ids: bytes) -> None:
        (self if len(self) < MOST_BYTE_PARTS else self.passing)[part] = ids

    def begin(self) -> None:
        """Before some texts: passing parts go if there are too many; none goes while the texts are encoded."""
        if len(self.passing) > PASSING_BYTE_PARTS:
            self.passing.clear()

    def learnt(self, found: dict) -> None:
        for part, ids in found.items():
            self.keep(part, ids)
        self.waiting.clear()


class Encoder:
    def __init__(self, name: str):
        self.tokenizer = Tokenizer.from_file(path(name))
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.known = Parts()
        self.tails: dict[str, bytes] = {}
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.latin = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, ord(_LAST_LATIN) + 1)}
        ids = [self.tokenizer.encode(b, add_special_tokens=False).ids for b in self.between]
        self.marks = [(b, i[-1], len(i)) for b, i in zip(self.between, ids)]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, parts: set) -> dict:
        """Encode parts that are new: many in one text, told apart by a mark between them."""
        found: dict = {}
        kinds: dict[int, list] = {}
        for p in parts:
            kinds.setdefault(self.mark_of(p), []).append(p)
        odd = kinds.pop(-1, [])
        for p, ids in zip(odd, self._ids([self.whole(p) for p in odd])):
            found[p] = ids.tobytes()
        for kind, a in ((kind, a) for kind, plain in kinds.items() for a in range(0, len(plain), 200)):
            some = kinds[kind][a : a + 200]
            between, mark_id, mark_length = self.marks[kind]
            text = between.join(map(self.whole, some)) + between
            (ids,) = self._ids([text])
            ends = np.flatnonzero(ids == mark_id) + 1
            if len(ends) != len(some):  # a part that swallows the mark: one by one
                for p, i in zip(some, self._ids([self.whole(p) for p in some])):
                    found[p] = i.tobytes()
                continue
            raw, start = ids.tobytes(), 0
            for p, end in zip(some, ends.tolist()):
                found[p] = raw[4 * start : 4 * (end - mark_length)]
                start = end
        return found

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        """Ids of a run of punctuation."""
        if tail not in self.tails:
            if len(self.tails) >= MOST_TAILS:
                self.tails.clear()
            self.tails[tail] = self._piece(tail)
        return self.tails[tail]


def joined(lists: pa.ListArray, words: pa.DictionaryArray, ids: list[bytes]) -> Iterator[bytes]:
    """Ids of each list of words, ``ids`` being those of each different word."""
    ends = np.cumsum([0, *map(len, ids)]) // 4
    kinds = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))
    rows = kinds.take(words.indices)
    ends = (4 * rows.offsets.to_numpy().astype(np.int64)[lists.offsets.to_numpy()]).tolist()
    raw = rows.values.to_numpy().tobytes()
    return (raw[a:b] for a, b in zip(ends, ends[1:]))


class WordEncoder(Encoder):
    """White space is dropped and letters lowered, so parts are words in lower case."""

    between = (f" {_MARK} ",)

    def __init__(self, name: str):
        super().__init__(name)
        self.plain = Tokenizer(self.model)  # the model alone, for pieces divided by a space
        self.plain.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a piece
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Each different word of the texts is looked up once."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
        words = pc.dictionary_encode(lists.flatten())
        wanted = words.dictionary.cast(pa.binary()).to_pylist()
        self.meet(wanted)
        return list(joined(lists, words, list(map(self.known.__getitem__, wanted))))

    def meet(self, wanted: list[bytes]) -> None:
        """Learn those of some different words that are new."""
        new = list(filterfalse(self.known.__contains__, wanted))  # lists keep words in the order of memory
        passing = list(filter(self.known.passing.__contains__, new))
        new = list(filterfalse(self.known.passing.__contains__, new))
        cut = list(map(self.cut, new))
        ids = self.pieces(list(dict.fromkeys(piece[0] for piece in cut if piece)))
        found = self.learn({part for part, piece in zip(new, cut) if not piece})
        found.update((part, ids[piece[0]] + self._tail(piece[1]) if piece[1] else ids[piece[0]]) for part, piece in zip(new, cut) if piece)
        self.known.add(found, passing)

    def cut(self, part: bytes) -> tuple[str, str] | None:
        """Latin letters as the model takes them, and punctuation after them: each is one piece, or empty (so is a word where
        a text ends in white space). None for all other words."""
        text = part.decode()
        if part.isalpha():
            return text, ""
        letters = text.rstrip(_PUNCTUATION)
        tail = text[len(letters) :]
        if letters.isascii():
            return None if letters and not letters.isalpha() else (letters, tail)
        letters = letters.lower()
        return None if not letters.isalpha() or max(letters) > _LAST_LATIN else (letters.translate(self.latin), tail)

    def pieces(self, wanted: list[str]) -> dict[str, bytes]:
        """Ids of pieces: many in one text, told apart by their last tokens."""
        found, pieces = {"": b""}, list(filter(None, wanted))
        for a in range(0, len(pieces), 200):
            some = pieces[a : a + 200]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                found.update((p, self._piece(p)) for p in some)
                continue
            raw, ends = ids.tobytes(), (4 * ends).tolist()
            found.update((p, raw[start:end]) for p, start, end in zip(some, [0, *ends], ends))
        return found

    def whole(self, part: bytes) -> str:
        return part.decode()

    def mark_of(self, part: bytes) -> int:
        return -1 if b"\x01" in part else 0


class ByteEncoder(Encoder):
    """Parts start where white space starts.

    A plain part is a word, which stands for itself after one space, or a single line feed and a
    word. A text with other white space, or with runs of it, is cut only where a space follows
    something else; those parts are kept as 1-tuples and stand as they are. So does the first part of
    any other text, which has a tab before it.
    """

    between = ("\n", f" {_MARK}")  # a line feed before a word's space is one token, and two line feeds would merge

    def __init__(self, name: str):
        super().__init__(name)
        self.known = Met(self.one)
        self.line_feed = self._piece("\u010a")

    def one(self, part) -> bytes | None:
        """Ids of a word of Latin letters, with or without punctuation after it: one or two pieces that the model takes as
        they are. A word's letters are encoded once, whatever follows them. None for all other parts."""
        word, before, lead = part, b"", "\u0120"  # the letter that stands for a space
        if isinstance(part, tuple):
            word, lead = part[0], ""
        elif part[0] == "\t":
            word, lead = part[1:], ""
        elif part[0] == "\n":
            word, before, lead = part[1:], self.line_feed, ""
        letters = word.rstrip(_PUNCTUATION)
        if not letters.isalpha() or not letters.isascii() and max(letters) > _LAST_LATIN:
            return None
        tail = word[len(letters) :]
        ids = self.known.have(letters) if lead and tail else None
        if ids is None:
            ids = self._piece(lead + (letters if letters.isascii() else letters.translate(self.latin)))
            if lead and tail:
                self.known.keep(letters, ids)
        if tail:
            if tail not in self.tails:
                if len(self.tails) >= MOST_TAILS:
                    self.tails.clear()
                self.tails[tail] = self._piece(tail)
            ids = ids + self.tails[tail]
        return before + ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each different part of the texts is looked up once; words are encoded where they are met first, other new parts together."""
        known, out, cut = self.known, [b""] * len(texts), [self.spaced(t) for t in texts]
        known.begin()
        plain = [n for n, t in enumerate(cut) if t]
        odd = {n: [(p,) for p in _CUTS.split(texts[n])] for n, t in enumerate(cut) if t is None}
        lists = pc.split_pattern(pa.array([cut[n] for n in plain], pa.string()), " ")
        words = pc.dictionary_encode(lists.flatten())
        wanted = [*words.dictionary.to_pylist(), *chain.from_iterable(odd.values())]
        ids = list(map(known.__getitem__, wanted))
        if known.waiting:
            known.learnt(self.learn(known.waiting))
            ids = list(map(known.__getitem__, wanted))
        last = len(words.dictionary)
        ends = np.cumsum([0, *map(len, ids[:last])]) // 4
        kinds = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids[:last]), np.int32)))
        rows = kinds.take(words.indices)
        ends = 4 * rows.offsets.to_numpy().astype(np.int64)[lists.offsets.to_numpy()]
        raw = rows.values.to_numpy().tobytes()
        for n, a, b in zip(plain, ends.tolist(), ends[1:].tolist()):
            out[n] = raw[a:b]
        for n, parts in odd.items():
            out[n] = b"".join(ids[last : last + len(parts)])
            last += len(parts)
        return out

    def spaced(self, text: str) -> str | None:
        """The text with its parts divided by one space, and a tab before the first. None if it is cut otherwise."""
        if not text:
            return ""
        spaced = text.replace("\n", " \n")
        if "  " in spaced or "\n " in spaced or spaced[0] == " " or spaced[-1] in " \n" or any(c in text for c in (_ASCII_SPACE if text.isascii() else _OTHER_SPACE)):
            return None
        return "\t" + spaced

    def whole(self, part) -> str:
        if isinstance(part, tuple):
            return part[0]
        return part[1:] if part[0] == "\t" else part if part[0] == "\n" else " " + part

    def mark_of(self, part) -> int:
        if isinstance(part, tuple) or part[0] == "\t" or _MARK in part:  # a tuple may end in white space
            return -1
        return int(part[0] == "\n")
