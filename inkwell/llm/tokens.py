"""Token ids of whole texts, as the tokenizers library gives them, at a fraction of its cost.

Plain texts (below U+0180, where normal form, case and character classes are the same in
every Unicode version in use) go through a rank-based byte-pair merger that is built from
the tokenizer's own file: its ids ascend in the order of its merges, so merging the pair of
least id is merging by the file's list.  For vocabularies with word ends the text is first
lower-cased and written with one space behind every pre-token, and that space takes the
place of the word end.  Other texts are cut before white space, where both pre-tokenizers
cut too; their plain pieces go the same way and the rest, like every text that holds an
added token's content, is left to the library.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: pieces that are not plain, kept with their ids by each worker at most; later ones are asked for each time
PIECES = 50_000
#: white space in a row that the merger's pattern, which recurses over it, is still given
RUN = 10_000
#: characters looked at together
SLICE_CHARS = 1 << 19

# A white-space run goes with the word behind it, or stands alone at the end.  White space
# is the Unicode property, as in the pre-tokenizers' patterns.
_CHUNK = regex.compile(r"\p{White_Space}*+\P{White_Space}++|\p{White_Space}++")
_LONG = regex.compile(rf"\p{{White_Space}}{{{RUN}}}")
# The patterns that the two kinds of pre-tokenization imply (fixed values of the formats).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: without next line, no-break space and the capital whose small letter is two characters
_PLAIN = regex.compile(r"[\x00-\x84\x86-\x9F\xA1-\u012F\u0131-\u017F]*+").fullmatch

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_CLASS = np.array([{"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x180)], np.uint8)
_CLASS[[*range(0x09, 0x0E), 0x20]] = _SPACE
_ENDS_ONE = np.isin(np.arange(0x180), [ord(c) for c in "stmd"])
_ENDS_TWO = [tuple(map(ord, pair)) for pair in ("re", "ve", "ll")]


def _byte_letters() -> dict[int, str]:
    """Byte -> the letter that stands for it in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return {b: chr(b if b in shown else next(other)) for b in range(256)}


def _merger(model: dict, suffix: str, pattern: str) -> tiktoken.Encoding:
    """A rank-based merger of a byte-level vocabulary, with a space for its word end; refuses one whose ids are not in the order of its merges."""
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)) or merged[0] < 256 * (2 if suffix else 1):
        raise ValueError("the vocabulary's ids are not in the order of its merges")
    back = {letter: bytes([b]) for b, letter in _byte_letters().items()}

    def raw(token: str) -> bytes:
        ended = bool(suffix) and token.endswith(suffix)
        return b"".join(back[c] for c in (token[: -len(suffix)] if ended else token)) + b" " * ended

    ranks = {raw(t): i for t, i in vocabulary.items()}
    if len(ranks) < len(vocabulary):
        raise ValueError("tokens with white space inside cannot be told from word ends")
    return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def spaced(texts: list[str]) -> list[str]:
    """Plain texts in lower case with one space behind each pre-token of WORDS, all other white space dropped or a space."""
    if not texts:
        return []
    joined = " ".join(texts).lower() + " "
    code = np.frombuffer(joined.encode("utf-16-le"), "<u2")
    kind = _CLASS[code]
    cut = (kind[:-1] != kind[1:]) | (kind[:-1] == _NUMBER)
    cut &= (kind[:-1] != _SPACE) & (kind[1:] != _SPACE)
    # an apostrophe that begins a run of signs may belong to the one or two letters behind it
    at = np.flatnonzero(code == 39)
    if len(at):
        at = at[(at == 0) | (kind[at - 1] != _OTHER)]
        after = [code[np.minimum(at + k, len(code) - 1)] for k in (1, 2)]
        one = at[_ENDS_ONE[after[0]]]
        two = at[np.logical_or.reduce([(after[0] == x) & (after[1] == y) for x, y in _ENDS_TWO])]
        for ends, width in ((one, 1), (two, 2)):
            cut[ends] = False
            cut[ends + width] = kind[ends + width + 1] != _SPACE
    shift = np.concatenate(([0], np.cumsum(cut)))
    out = np.full(len(code) + int(shift[-1]), 32, "<u2")
    out[np.arange(len(code)) + shift] = np.where(kind == _SPACE, 32, code)
    text = out.tobytes().decode("utf-16-le")
    ends = np.cumsum([len(t) + 1 for t in texts])
    ends = (ends + shift[ends - 1]).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Encoder:
    """Ids of texts by one tokenizer file, as little-endian unsigned 32-bit bytes.

    ``special_tokens``: whether an added token's content within a text is that token, as
    the library has it by default, or ordinary text.
    """

    def __init__(self, path: str, special_tokens: bool = True) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        steps = json.loads(self.tokenizer.to_str())
        if any(t["normalized"] or not (t["special"] or special_tokens) for t in steps["added_tokens"]):
            raise ValueError(f"{path}: holds added tokens that are looked for in normalised text")
        self.added = [t["content"] for t in steps["added_tokens"]] if special_tokens else []
        kinds = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        pre, model = steps["pre_tokenizer"], steps["model"]
        suffix = model["end_of_word_suffix"] or ""
        if kinds == [] and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not suffix:
            self.words = False
        elif kinds == ["NFC", "Replace", "Lowercase"] and suffix and pre["pretokenizers"][0]["behavior"] == "Removed" and pre["pretokenizers"][0]["pattern"]["Regex"] == WORDS:
            self.words = True
        else:
            raise ValueError(f"{path}: neither byte-level BPE nor lower-cased BPE with word ends")
        # the same pre-tokens as BYTE_LEVEL's, by possessive repetition; each ends at its space in ``spaced``
        possessive = r"'(?:[stmd]|re|ve|ll)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s++"
        self.merge = _merger(model, suffix, "[^ ]+ " if self.words else possessive).encode_ordinary
        self.size = self.tokenizer.get_vocab_size()
        self.held: dict[str, bytes] = {}

    def by_library(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _long(self, text: str) -> bool:
        return not self.words and len(text) >= RUN and _LONG.search(text) is not None

    def by_pieces(self, text: str) -> bytes:
        """A text that is not plain, or has a long run of white space, cut before white space; runs of pieces that are plain go together."""
        out: list[bytes] = []
        plain: list[str] = []

        def close() -> None:
            if plain:
                out.append(self.by_merger(["".join(plain)])[0])
                plain.clear()

        for piece in _CHUNK.findall(text):
            if _PLAIN(piece) and not self._long(piece):
                plain.append(piece)
                continue
            close()
            ids = self.held.get(piece)
            if ids is None:
                ids = self.by_library(piece)
                if len(self.held) < PIECES and len(piece) < 200:
                    self.held[piece] = ids
            out.append(ids)
        close()
        return b"".join(out)

    def by_merger(self, texts: list[str]) -> list[bytes]:
        return [array("I", self.merge(t)).tobytes() for t in (spaced(texts) if self.words else texts)]

    def many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text in turn; a null is an empty text.  Texts are looked at some together, never cut."""
        waiting: list[str] = []
        chars = 0
        for text in texts:
            waiting.append(text or "")
            chars += len(waiting[-1])
            if chars >= SLICE_CHARS:
                yield from self._some(waiting)
                waiting, chars = [], 0
        yield from self._some(waiting)

    def _some(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if any(content in t for content in self.added):
                out[i] = self.by_library(t)
            elif (t.isascii() or _PLAIN(t)) and not self._long(t):
                plain.append(i)
            else:
                out[i] = self.by_pieces(t)
        for i, ids in zip(plain, self.by_merger([texts[i] for i in plain]), strict=True):
            out[i] = ids
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def load(path: str, special_tokens: bool = True) -> Encoder:
    """The worker process's one encoder of a file."""
    if (path, special_tokens) not in _ENCODERS:
        _ENCODERS[path, special_tokens] = Encoder(path, special_tokens)
    return _ENCODERS[path, special_tokens]


def encoder(path: str, special_tokens: bool = True) -> Callable[[str], bytes]:
    """text -> ids, one text at a time."""
    some = load(path, special_tokens)._some
    return lambda text: some([text])[0]
