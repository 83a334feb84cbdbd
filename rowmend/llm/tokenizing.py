"""Tokenizers inside tasks: whole texts as the library encodes them, repeated pieces encoded once.

A text is cut where no token of the tokenizer can reach across: before a blank, in front of
other white space and between Latin letters and punctuation. What stands between two blanks
is taken once for all texts of a batch and cut into words and marks, and those that are not
in a cache of bounded size are encoded by the library. Where such a cut is not proven (other
kinds of tokenizers, unusual white space), the library gets the whole text.
"""

from __future__ import annotations

import array
import gc
import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rowmend.llm.rows import release, worker_cache

CACHED_PIECES = 400_000  # words and marks of either generation that a worker keeps; about 150 MB in all
COLLECT_EVERY = 200_000  # new objects between two looks for cycles, of which there are none here
BATCH_CHARS = 1 << 22  # characters of text worked on at once

# White space on whose nature all regular expression engines agree, and the other kind.
# A line break alone is a token before a letter. A word of Latin letters ends before these marks; an apostrophe is none of them, as "'s" is a token of its own.
_PIECES = re.compile(
    r"\n(?=[A-Za-zÀ-ÖØ-öø-ɏ])|[ \t\r\n]*(?:[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[ \t\r\n.,;:!?)]|\Z)|[^ \t\r\n]+)|[ \t\r\n]+"
)
_ODD_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \t\r\n"] + list("\u180e\u200b\ufeff")
_WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = frozenset(".,;:!?)")
# Blanks after which a run of white space goes on, so that a cut before them would part the run.
_LONG_SPACE = ("  ", " \t", " \n", " \r")

# The same for tokenizers that drop white space and letter case.
_LOWER_PIECES = re.compile(r"[a-zß-öø-ÿ]+(?=[.,;:!?)]|\Z)|.+", re.DOTALL)
_LOWER_WORD = re.compile(r"[a-zß-öø-ÿ]+")
# Letters whose lower case depends on nothing but themselves.
_OTHER_CASES = re.compile("[^\x00-\u012f\u0131-\u024f]")
# How such a tokenizer's file describes itself.
_DROPS_SPACE = (
    [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
)


def _visible_bytes() -> dict[int, int]:
    """Byte-level tokenizers show printable Latin-1 bytes as they are, and the others from code point 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def batches(texts: Sequence[str]) -> Iterator[list[str]]:
    """Consecutive texts of about BATCH_CHARS characters in all."""
    batch, held = [], 0
    for text in texts:
        batch.append(text)
        held += len(text)
        if held >= BATCH_CHARS:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


class _Cached:
    """Looks pieces up in a cache of bounded size; a subclass encodes the missing ones.

    Full, the cache becomes the older generation, whose pieces return when they are met again.
    """

    def __init__(self) -> None:
        self.known: dict = {}
        self.older: dict = {}

    def _encode(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def rest(self) -> None:
        """At the end of a task: a worker that waits, or turns to other work, keeps the common pieces only."""
        self.older = {}
        release()

    def _learn(self, pieces: set[str]) -> None:
        if len(self.known) > CACHED_PIECES:
            self.known, self.older = {}, self.known
        missing = pieces.difference(self.known)
        if self.older:
            met = {p: self.older[p] for p in missing if p in self.older}
            self.known.update(met)
            missing.difference_update(met)
        listed = list(missing)
        self.known.update(zip(listed, self._encode(listed), strict=True))


class Generations:
    """Values made on first use. Full, ``known`` becomes ``older``, whose entries return when they are met again."""

    def __init__(self, make: Callable, most: int) -> None:
        self.make, self.most = make, most
        self.known: dict = {}
        self.older: dict = {}

    def one(self, key):
        value = self.known.get(key)
        if value is None:
            value = self.older.get(key)
            if value is None:
                value = self.make(key)
            if len(self.known) >= self.most:
                self.known, self.older = {}, self.known
            self.known[key] = value
        return value

    def all(self, keys: list) -> list:
        values = list(map(self.known.get, keys))
        if None in values:
            values = [self.one(k) if v is None else v for k, v in zip(keys, values)]
        return values


class IdEncoder:
    """Ids of a tokenizers file as bytes, ``width`` bytes an id."""

    def __init__(self, path: str, most: int | None = None) -> None:
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.lower() for t in added]
        plain = not any(t.lstrip or t.rstrip or re.search(r"\s", t.content) for t in added)
        # Byte-level tokens hold white space only in front; without a normalizer nothing else looks across.
        self.cuts = (
            isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
            and not self.tokenizer.pre_tokenizer.add_prefix_space
            and self.tokenizer.normalizer is None
            and plain
        )
        # Others drop it, and then nothing reaches from one word to the next.
        described = json.loads(self.tokenizer.to_str())
        steps = [(described[k] or {}).get(n) for k, n in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.drops = plain and steps == list(_DROPS_SPACE) and not any(t.normalized or t.single_word for t in added)

        # A word is one unit of its model, which can be asked directly, at half the cost.
        self.visible, self.ask = _visible_bytes(), self.tokenizer.model.tokenize
        self.blank = chr(self.visible[0x20])
        self.is_word, probe = _WORD.fullmatch, [" word", "Wörter", " étéɏ"]
        if self.drops:
            self.is_word, probe = _LOWER_WORD.fullmatch, ["word", "wörter", "été"]
        self.words = (self.cuts or self.drops) and [self._whole(p) for p in probe] == [self._word(p) for p in probe]
        self.known = Generations(self._part, CACHED_PIECES if most is None else most)

    def rest(self) -> None:
        """At the end of a task: a worker that waits, or turns to other work, keeps the common pieces only."""
        self.known.older = {}
        release()

    def _bytes(self, ids: list[int]) -> bytes:
        return array.array("H" if self.width == 2 else "I", ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _unit(self, shown: str) -> bytes:
        return self._bytes([t.id for t in self.ask(shown)])

    def _word(self, piece: str) -> bytes:
        return self._unit(piece.encode().decode("latin-1").translate(self.visible))

    def _part(self, piece: str) -> bytes:
        if not (self.words and self.is_word(piece)):
            return self._whole(piece)
        if piece.isascii():
            return self._unit(self.blank + piece[1:] if piece[0] == " " else piece)
        return self._word(piece)

    def _cut(self, text: str) -> bytes:
        return b"".join(self.known.all(_PIECES.findall(text)))

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of what stands between blanks."""
        front, cut = ("", _LOWER_PIECES) if self.drops else (" ", _PIECES)
        known, one = self.known.known.get, self.known.one
        plain = not self.drops  # with a blank in front ASCII letters are a word, which needs no pattern
        values = []
        for piece in pieces:
            whole = front + piece
            value = known(whole)
            if value is None:
                word = whole[:-1]
                if piece.isascii() and piece.isalpha() and self.words:
                    value = one(whole)
                elif piece[-1:] in _MARKS and (plain and piece[:-1].isalpha() and piece.isascii() or word[-1:] != "" and self.is_word(word)):
                    value = (known(word) or one(word)) + (self.known.known.get(piece[-1]) or one(piece[-1]))
                else:
                    value = b"".join(map(one, cut.findall(whole)))
                known = self.known.known.get  # the cache may have turned over
            values.append(value)
        return values

    def _split(self, text: str) -> tuple[bytes, str | None]:
        """Ids of the text's beginning, and what follows it, to be looked up piece by piece."""
        if self.drops and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            # Case is taken from texts of plain letters; not if that might make a special token, which the library knows as it is.
            lower = text.lower()
            return b"", text if _OTHER_CASES.search(text) or any(t in lower for t in self.special) else lower
        if not self.cuts or any(c in text for c in _ODD_SPACE):
            return self._whole(text), None
        if any(run in text for run in _LONG_SPACE):
            return self._cut(text), None
        first, blank, others = text.partition(" ")
        return self._cut(first), others if blank else None

    def _looked_up(self, rests: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together, and where each one's end."""
        texts = pa.array(rests, pa.string())
        split = pc.ascii_split_whitespace(texts) if self.drops else pc.split_pattern(texts, " ")
        pieces = split.flatten().dictionary_encode()
        dtype = np.uint16 if self.width == 2 else np.uint32
        # By way of an array of objects: to_pylist makes a scalar of each piece first, at many times the cost.
        values = self._pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.width
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = np.frombuffer(b"".join(values), dtype)
        place = pieces.indices.to_numpy()
        after = np.concatenate([[0], np.cumsum(sizes[place])])
        counts = np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy())
        # Where each id of the texts stands among those of the pieces.
        found = np.repeat(ends[:-1][place] - after[:-1], sizes[place]) + np.arange(after[-1])
        return ids[found], after[counts]

    def encode(self, texts: Sequence[str]) -> Iterator[bytes]:
        gc.set_threshold(COLLECT_EVERY)
        for batch in batches(texts):
            heads, rests = zip(*map(self._split, batch))
            ids, ends = self._looked_up(rests)
            for head, first, last in zip(heads, [0, *ends[:-1].tolist()], ends.tolist()):
                yield head + ids[first:last].tobytes()


class IdCounter(_Cached):
    """Numbers of ids, of a tokenizers file (.json) or a sentencepiece model (.model)."""

    def __init__(self, path: str) -> None:
        super().__init__()
        if path.endswith(".json"):
            self.ids, self.cuts = IdEncoder(path), False
            return
        import sentencepiece

        self.ids = None
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.cuts = _keeps_spaces(self.model) and not any("▁" in p.lstrip("▁") for p in pieces)

    def rest(self) -> None:
        super().rest()
        if self.ids is not None:
            self.ids.rest()

    def _encode(self, pieces: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(pieces, num_threads=1)] if pieces else []

    def count(self, texts: Sequence[str]) -> Iterator[int]:
        if self.ids is not None:
            for ids in self.ids.encode(texts):
                yield len(ids) // self.ids.width
            return
        for batch in batches(texts):
            # A blank between two words becomes the mark in front of the second one, which a text of its own gets as well.
            cut = [t.split(" ") if self.cuts and "▁" not in t else [""] for t in batch]
            cut = [words if all(words) else None for words in cut]
            self._learn(set().union(*[c for c in cut if c is not None]))
            for text, words in zip(batch, cut):
                yield self._encode([text])[0] if words is None else sum(map(self.known.__getitem__, words))


def _keeps_spaces(model) -> bool:
    """Whether the model only puts a mark in front and marks blanks, and changes nothing else."""
    probe = " a  béﬁ　c\t d  "
    try:
        return model.normalize(probe) == "▁" + probe.replace(" ", "▁") and model.normalize("a") == "▁a"
    except AttributeError:
        return False


def loaded(kind: type, path: str, *more):
    """The encoder of this worker process, with what it has cached."""
    kept = worker_cache("tokenizers")
    if (kind, path, *more) not in kept:
        kept[kind, path, *more] = kind(path, *more)
    return kept[kind, path, *more]
