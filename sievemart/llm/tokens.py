"""Token ids of whole texts from a public byte-level BPE vocabulary.

A byte-level tokenizer with the usual splitting pattern always starts a new
pre-token at a space that a non-space follows: no alternative of the pattern
holds such a space anywhere but in front, and a run of white space leaves its
last space to the next word.  A text may therefore be cut there, and each chunk,
which is one or a few whole pre-tokens, encoded by itself.  Texts that hold an
added token's string, and tokenizers of another kind, are encoded whole.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array

WORD_START = re.compile(r" (?=\S)")
OTHER_SPACE = re.compile(r" (?=\s|\Z)")

#: Chunks a worker keeps; longer ones than ``LONG_CHUNK`` are not kept.
KEPT_CHUNKS = 400_000
LONG_CHUNK = 64


def chunks(text: str) -> list[str]:
    """The chunks of a text; all but the first lack the space they start with."""
    if OTHER_SPACE.search(text):
        return WORD_START.split(text)
    return text.split(" ")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """The tokenizer of a vocabulary file; one per worker and vocabulary."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        with open(vocabulary, encoding="utf-8") as file:
            parts = json.load(file)
        splitter = parts.get("pre_tokenizer") or {}
        self.by_chunk = (
            splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space", True)
            and not parts.get("normalizer")
            and parts["model"]["type"] == "BPE"
        )
        self.added = [token["content"] for token in parts.get("added_tokens") or []]

    @classmethod
    def load(cls, vocabulary: str) -> Encoder:
        if vocabulary not in cls._loaded:
            cls._loaded[vocabulary] = cls(vocabulary)
        return cls._loaded[vocabulary]

    def whole_only(self, text: str) -> bool:
        return not self.by_chunk or any(token in text for token in self.added)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class RankEncoder:
    """The same ids from the vocabulary's rank file, by the library that reads those.

    It encodes whole texts about four times as fast.  Strings of added tokens
    inside a text become those tokens, as the other library does by default.
    """

    _loaded: dict[str, RankEncoder] = {}

    # Fixed value: the added token of the vocabulary.
    ADDED = {"<|endoftext|>": 50256}

    def __init__(self, ranks: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.encoding = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens=self.ADDED,
        )

    @classmethod
    def load(cls, ranks: str) -> RankEncoder:
        if ranks not in cls._loaded:
            cls._loaded[ranks] = cls(ranks)
        return cls._loaded[ranks]

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
