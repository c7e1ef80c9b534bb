"""Token ids of the word-end BPE tokenizer, through a cache of whitespace-separated chunks.

The vocabulary's splits never cross white space, nor does its normalisation, so a text's ids are those of its chunks,
one after the other. Chunks of plain Latin text are encoded by a byte-level BPE built from the same vocabulary (word
ends become one terminating byte); a chunk with other characters goes to the tokenizer itself. A text that has such
characters is cut at ASCII white space alone, which all of Unicode's notions of white space agree on.
"""

from __future__ import annotations

import array
import json
import re

from ._common import held

#: What the quick path takes: printable ASCII, \t, \n, \r and precomposed Latin letters whose lower case is one letter.
_OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ſ]")
_CUT = re.compile("[\t\n\r ]+")
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\\sa-z0-9ß-öø-ſ]+")
#: A byte that UTF-8 never uses stands for the end of a word.
_END = b"\xff"

#: Bytes of chunks and ids that a worker keeps, and the longest chunk that it does; others are encoded each time.
CHUNK_BYTES, KEPT_CHARS = 80 << 20, 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _bytes_of_symbols() -> dict[str, int]:
    """The usual byte-level alphabet: visible Latin-1 stands for itself, the rest for code points from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class WordBpe(dict):
    """Maps a chunk, lower-cased if it is plain Latin text, to its ids as bytes (little-endian uint16); keeps about
    ``CHUNK_BYTES`` of them."""

    room = CHUNK_BYTES

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["id"] for x in spec["added_tokens"]}
        symbols, ranks = _bytes_of_symbols(), {}
        for token, i in spec["model"]["vocab"].items():
            if i not in special:
                body, end = (token[:-4], _END) if token.endswith("</w>") and len(token) > 4 else (token, b"")
                ranks[bytes(symbols[c] for c in body) + end] = i
        self._piece = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text

    def __missing__(self, chunk: str) -> bytes:
        if _OTHER.search(chunk):
            ids = array.array("H", self.whole.encode(chunk, add_special_tokens=False).ids)
        else:
            ids = array.array("H")
            for word in (chunk,) if chunk.isalpha() else _WORDS.findall(chunk):
                ids.extend(self._piece(word.encode() + _END))
        out = ids.tobytes()
        if self.room > 0 and len(chunk) <= KEPT_CHARS:
            self.room -= len(chunk) + len(out) + 180
            self[chunk] = out
        return out

    def ids(self, text: str) -> bytes:
        """All ids of a text, as little-endian uint16."""
        if _OTHER.search(text):
            return b"".join(self[c if _OTHER.search(c) else c.lower()] for c in _CUT.split(text))
        return b"".join(map(self.__getitem__, text.lower().split()))


def load(path: str) -> WordBpe:
    """The tokenizer of a worker process, made once."""
    return held(("word-bpe", path), lambda: WordBpe(path))
