"""Token ids of whole texts by a given tokenizer file of the tokenizers library.

The library spends most of its time on words it has seen before. Both vocabularies
encode every pre-token by itself, so a worker keeps the ids of the pre-tokens
it has met and hands the library's merge model only new ones. Texts with characters for which the
split below is not certain to be the library's own (anything outside basic and
extended Latin, unusual blanks, strings of special tokens) are encoded whole by
the library; the result is the same either way.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable

import numpy as np

# letters and numbers of the code points that SAFE admits
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-į"
_NUMBER = "0-9²³¹¼-¾"
_BLANK = "\t\n\r "
SAFE = r"[\t\n\r\x20-\x7e¡-į]*"
# how the two kinds of vocabulary cut a text before merging
BYTE_SPLIT = (
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
WORD_SPLIT = f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+"
KEPT = 200_000  # pre-tokens of a generation; the memory they take is bounded


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class _Known(dict):
    """Pre-token -> its ids as bytes; asks the vocabulary's merge model for those it has not met.

    Two generations: when the young one is full it becomes the old one, so that
    frequent pre-tokens stay and memory is bounded.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.merge, self.alphabet, self.old = tokenizer.model.tokenize, _byte_alphabet(), {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            shown = piece.encode().decode("latin1").translate(self.alphabet)
            found = array("I", [t.id for t in self.merge(shown)]).tobytes()
        self[piece] = found
        return found

    def age(self) -> None:
        if len(self) > KEPT:
            self.old = dict(self)
            self.clear()


def _worker_state(definition: str) -> dict:
    """The tokenizer and its known pre-tokens, kept between the tasks of a Python worker."""
    from tokenizers import Tokenizer

    home = sys.modules.setdefault("feira_worker_state", types.ModuleType("feira_worker_state"))
    states = vars(home).setdefault("tokenizers", {})
    if definition not in states:
        tokenizer = Tokenizer.from_str(definition)
        states[definition] = {"tokenizer": tokenizer, "known": _Known(tokenizer)}
    return states[definition]


def text_encoder(definition: str, split: str, lower: bool) -> Callable[[list], list[bytes]]:
    """A function from texts (None: empty) to their ids as little-endian unsigned 32-bit integers.

    ``definition`` is the content of the tokenizer file; ``lower`` says that the
    vocabulary ignores case.
    """
    state = _worker_state(definition)
    tokenizer, known = state["tokenizer"], state["known"]
    pieces_of, safe = re.compile(split).findall, re.compile(SAFE).fullmatch
    ids_of = known.__getitem__

    def encode(texts: list) -> list[bytes]:
        out: list[bytes] = []
        for text in texts:
            text = text or ""
            if "<|" in text or not safe(text):
                ids = tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.asarray(ids, dtype="<u4").tobytes())
            else:
                out.append(b"".join(map(ids_of, pieces_of(text.lower() if lower else text))))
                known.age()
        return out

    return encode


def vocabulary(name: str) -> str:
    """Content of a public tokenizer file, to be handed to the operators."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def model_file(name: str) -> bytes:
    """Content of a public model file, to be handed to the operators."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()
