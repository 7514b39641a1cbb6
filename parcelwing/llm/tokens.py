"""Token ids of many texts by a tokenizers file, nothing remembered between texts.

The file's vocabulary is given to a faster merger, tiktoken, which joins the same
pairs in the same order: in these files an id is also the rank of its merge. A
vocabulary whose words carry an end mark gets it as a zero byte after each word.
Characters on whose class, case or composed form libraries may differ, and added
tokens where they are to be found, send a text to the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
from array import array
from functools import lru_cache

import regex
import tiktoken

# Spark runs a task per core; threads of the library would only wait for one another
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

# fixed values: how the two kinds of files split a text into pre-tokens
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CLIP_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
WORD_END = "\x00"
LONG_RUN = 50_000
# long-assigned characters; with a normalizer only those that are composed and lower-cased one by one
KNOWN = r"\t\n\r\x20-\x7e\xa0-ɏͰ-ϿЀ-ӿ‐-‧€぀-ヿ一-龥가-힣"
KNOWN_CASED = r"\t\n\r\x20-\x7e\xa0-\xb4\xb6-\xff‐-‧€"


def _byte_alphabet() -> dict[str, int]:
    """The bytes that the printable characters of byte-level vocabularies stand for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _ranks(vocabulary: dict[str, int], end: str) -> dict[bytes, int]:
    """id of every token by its bytes, a word's end as a zero byte."""
    alphabet = _byte_alphabet()
    out = {}
    for token, number in vocabulary.items():
        last = bool(end) and token.endswith(end)
        body = token[:-len(end)] if last else token
        out[bytes(alphabet[c] for c in body) + b"\0" * last] = number
    return out


class PieceEncoder:
    """ids (little-endian unsigned 32-bit, as bytes) of texts for one tokenizer file.

    With `added`, strings such as <|endoftext|> in a text get the ids of the
    file's added tokens, the library's default; without, they are plain text.
    """

    def __init__(self, path: str, added: bool = False):
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not added
        model = json.loads(self.whole.to_str())["model"]
        extra = self.whole.get_added_tokens_decoder()
        words = {token: number for token, number in model["vocab"].items() if number not in extra}
        end = model["end_of_word_suffix"] or ""
        # only a file with word ends normalizes: lower case, composed, white space dropped
        self.words = regex.compile(CLIP_PATTERN) if end else None
        pattern = f"[^{WORD_END}]+{WORD_END}" if end else GPT_PATTERN
        self.merger = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=_ranks(words, end), special_tokens={})
        names = [regex.escape(token.content) for token in extra.values()] if added else []
        self.odd = regex.compile("|".join([f"[^{KNOWN_CASED if end else KNOWN}]", *names]))
        self.run = regex.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._one(text) for text in texts]

    def _one(self, text: str) -> bytes:
        if self.odd.search(text) or len(text) >= LONG_RUN and self.run.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.words:
            text = "".join([word + WORD_END for word in self.words.findall(text.lower())])
        return array("I", self.merger.encode_ordinary(text)).tobytes()


@lru_cache(maxsize=4)
def piece_encoder(path: str, added: bool = False) -> PieceEncoder:
    return PieceEncoder(path, added)
