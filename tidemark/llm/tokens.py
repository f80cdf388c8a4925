"""Token ids of the public word-end BPE tokenizer, fast enough for a corpus.

White space ends every pre-token of this tokenizer, so a text's ids are the
joined ids of its white-space chunks. Chunks are looked up in a bounded cache;
a missing chunk of plain Latin characters goes through the same steps as the
tokenizer's own normaliser and splitter and then through its merges, run by a
byte-pair encoder over the same vocabulary; any other chunk is encoded by the
whole tokenizer. Tests hold the ids against the whole tokenizer's.
"""

from __future__ import annotations

import re
import struct


#: fixed splitting pattern of the tokenizer, for lower-case plain Latin chunks
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
#: characters whose normalised form and class are the same chunk by chunk
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def _byte_symbols() -> list[str]:
    """The printable stand-in for each byte, by the byte-level rule: printable
    Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


#: stands for the end of a word; never part of UTF-8
_END = b"\xff"


def _merger(whole):
    """The vocabulary as ranked byte strings. Ids follow the order of the
    merges, and a last byte with its word end ranks before every merge, so
    merging by lowest rank gives the tokenizer's own merges."""
    from tiktoken import _tiktoken

    byte = {c: bytes([b]) for b, c in enumerate(_byte_symbols())}
    ranks = {}
    for token, i in whole.get_vocab(with_added_tokens=False).items():
        end = token.endswith("</w>")
        body = b"".join([byte[c] for c in (token[:-4] if end else token)]) if not token.startswith("<|") else None
        if body is not None:
            ranks[body + _END if end else body] = i
    return _tiktoken.CoreBPE(ranks, {}, ".+")


class TokenIds:
    """``encode(text)``: ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache: int = 200_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pairs = _merger(self.whole)
        self.limit = cache
        self.chunks: dict[bytes, bytes] = {}

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            ids = [i for p in _PRE.findall(text.lower()) for i in self.pairs.encode_single_piece(p.encode() + _END)]
        else:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        got = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.chunks) < self.limit:  # the first words seen are the frequent ones
            self.chunks[chunk] = got
        return got

    def encode(self, text: str) -> bytes:
        chunks, known = text.encode().split(), self.chunks.get
        return b"".join([known(c) or self._chunk(c) for c in chunks])


_LOADED: dict[str, TokenIds] = {}


def loaded(path: str) -> TokenIds:
    """One tokenizer (and cache) per worker process."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
