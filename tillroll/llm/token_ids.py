"""Token ids of whole texts, in tasks, with any tokenizer file of the tokenizers library."""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata

import numpy as np

#: Words, and parts of words, whose ids a worker remembers at most; beyond, it starts afresh.
REMEMBERED = 300_000


def _apart_at_spaces(config: dict) -> bool:
    """Whether texts can be encoded between their spaces, one piece at a time.

    True if the normaliser at most composes characters, folds white space and
    lower-cases, and the pre-tokenizer first keeps only what its pattern
    matches, none of whose parts can hold white space.
    """
    normal = config.get("normalizer") or {}
    steps = normal.get("normalizers", [normal] if normal else [])
    for s in steps:
        if s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ":
            continue
        if s["type"] not in ("NFC", "NFD", "Lowercase"):
            return False
    before = config.get("pre_tokenizer") or {}
    first = (before.get("pretokenizers") or [before])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    spaceless = all(p in (r"[\p{L}]+", r"[\p{N}]", r"[\p{N}]+", r"[^\s\p{L}\p{N}]+") or re.fullmatch(r"'[a-z]+", p)
                    for p in pattern.split("|"))
    later = (before.get("pretokenizers") or [])[1:]
    return (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
            and bool(pattern) and spaceless
            and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] for x in later)
            and config.get("post_processor") is None and config["model"]["type"] == "BPE"
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"])
                        for a in config.get("added_tokens", [])))


def _part_pattern(config: dict) -> str | None:
    """The pre-tokenizer's pattern, if words of plain Latin letters can be cut into parts here.

    Then the normaliser does no more to such words than to lower-case them, each match of
    the pattern is encoded by itself, and the ids of a part end with a token that ends a word.
    """
    steps = [s["type"] for s in (config.get("normalizer") or {}).get("normalizers", [])]
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    ok = (_apart_at_spaces(config) and set(steps) == {"NFC", "Replace", "Lowercase"} and len(before) == 2
          and before[1].get("use_regex") is False and config["model"].get("end_of_word_suffix")
          and not config["model"].get("ignore_merges"))
    return before[0]["pattern"]["Regex"] if ok else None


def _plain_characters() -> list[str]:
    """Characters below U+0250 that are cut and lower-cased here as the tokenizer does it.

    Each is lower-cased by itself to one character, which is below U+0250 too, so the pattern's letters
    and numbers are those of this range; none is changed by composition. Of the control characters only white space.
    """
    def fits(c: str) -> bool:
        low = c.lower()
        return (len(low) == 1 and ord(low) < 0x250 and unicodedata.normalize("NFC", c) == c
                and (unicodedata.category(c) not in ("Cc", "Cf", "Cn") or c in "\t\n\x0b\x0c\r")
                and (c == " " or unicodedata.category(c)[0] != "Z"))

    return [chr(k) for k in range(0x250) if fits(chr(k))]


_PLAIN_TEXT = re.compile(f"[{re.escape(''.join(_plain_characters()))}]*").fullmatch


def _for_plain_text(pattern: str) -> str:
    """The pattern with its classes of letters and numbers written out for these characters."""
    def ranges(kind):
        return "".join(re.escape(chr(k)) for k in range(0x250) if unicodedata.category(chr(k)).startswith(kind))

    return pattern.replace(r"\p{L}", ranges("L")).replace(r"\p{N}", ranges("N"))


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes; equal to encoding each whole text.

    Texts of plain characters are cut into the pre-tokenizer's parts (lower-cased runs of
    letters, of signs, single digits) here, other texts at spaces; each distinct part
    or word is encoded once, in batches.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.apart = _apart_at_spaces(config)
        pattern = _part_pattern(config)
        self.parts_of = re.compile(_for_plain_text(pattern)).findall if pattern else None
        if pattern:
            self.special = [a["content"] for a in config["added_tokens"]]
            suffix = config["model"]["end_of_word_suffix"]
            self.ends = np.zeros(self.vocabulary, bool)
            self.ends[[i for t, i in config["model"]["vocab"].items() if t.endswith(suffix)]] = True
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn_parts(self, new: list[str]) -> None:
        """Encode all parts in one text and cut its ids behind the tokens that end a part."""
        for at in range(0, len(new), 10_000):
            some = new[at:at + 10_000]
            ids = np.array(self.bare.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(some):
                raise ValueError("parts and ends of parts differ in number")
            data, begin = ids.tobytes(), 0
            for p, end in zip(some, (cut * 4).tolist()):
                self.parts[p] = data[begin:end]
                begin = end

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > REMEMBERED:
            self.parts = {}
        found = [self.parts_of(t.lower()) for t in texts]
        self._learn_parts([p for p in set().union(*found) if p not in self.parts])
        get = self.parts.__getitem__
        return [b"".join(map(get, f)) for f in found]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > REMEMBERED // 4:
            self.words = {"": b""}
        found = [t.replace("\n", " ").split(" ") for t in texts]
        new = [w for w in set().union(*found) if w not in self.words]
        self.words.update(zip(new, self._plain(new)))
        get = self.words.__getitem__
        return [b"".join(map(get, f)) for f in found]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One byte string per text; a null text is empty."""
        texts = [t or "" for t in texts]
        if not self.apart:
            return self._plain(texts)
        plain = [self.parts_of is not None and _PLAIN_TEXT(t) is not None
                 and not any(x in t for x in self.special) for t in texts]
        by_parts = iter(self._by_parts([t for t, ok in zip(texts, plain) if ok]) if any(plain) else ())
        by_words = iter(self._by_words([t for t, ok in zip(texts, plain) if not ok]) if not all(plain) else ())
        return [next(by_parts if ok else by_words) for ok in plain]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder; its remembered words serve all its tasks."""
    return Encoder(path)


def production_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
