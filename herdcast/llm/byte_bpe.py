"""Encoding by a byte-level BPE vocabulary file, for tasks that encode many texts."""

from __future__ import annotations

import json


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies: itself if visible, else the next from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Ids of texts under a tokenizers file, by the faster of two public encoders that agree on it.

    A file whose merges are numbered in the order of the ids, cut by the usual pattern and without a normaliser, gives the
    same ids from its ranks (tiktoken). Any other file, and any text that holds a special token's string while those
    are ``special``, goes through tokenizers itself. With ``special`` false such strings are plain text.
    """

    def __init__(self, rules: str, special: bool):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.plain = Tokenizer.from_str(rules)
        self.plain.encode_special_tokens = not special
        said = json.loads(rules)
        self.specials = [t["content"] for t in said["added_tokens"]] if special else []
        alphabet = byte_alphabet()
        added = {t["content"] for t in said["added_tokens"]}
        vocab = {t: i for t, i in said["model"]["vocab"].items() if t not in added}
        #: bytes of each id; a special token stands for no bytes of a text
        self.bytes = [b""] * (1 + max([*said["model"]["vocab"].values(), *[t["id"] for t in said["added_tokens"]]]))
        for token, i in vocab.items():
            self.bytes[i] = bytes(map(alphabet.__getitem__, token))
        self.fast = self._ranked(said, vocab) if self._usual(said, vocab) else None

    @staticmethod
    def _usual(said: dict, vocab: dict[str, int]) -> bool:
        cut = said.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in said["model"].get("merges", [])]
        made = [vocab.get(m.replace(" ", ""), -1) for m in merges]
        return (said["model"].get("type") == "BPE" and said.get("normalizer") is None and said.get("truncation") is None
                and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
                and made == sorted(set(made)) and bool(made) and made[0] >= 256 and len(vocab) == len(made) + 256)

    def _ranked(self, said: dict, vocab: dict[str, int]):
        import tiktoken
        # Fixed value: the cutting pattern of byte-level vocabularies.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks={self.bytes[i]: i for i in vocab.values()}, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.specials):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)
