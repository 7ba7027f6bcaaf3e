"""Exact sub-word encoding of whole texts, in bounded memory.

``WordEncoder`` runs a word-level file (lower case, white space dropped, words
with an end mark) in ``tiktoken``: words are spaced out, the space after a word
is its end mark, and the ranks of the file are those of the merges. It holds no
memo. Stretches with characters outside a plain set go to the ``tokenizers``
library, so the ids are those of the library on every text.

``ChunkEncoder`` takes any other file, with a memo of words. Both vocabularies cut a text into words before any merge. A run of Latin
letters after a space (or at the start of a line whose predecessor ends in a
visible character) that ends before a space, a full stop, a comma, a line end
or the end of the text is such a word, whatever surrounds it: the byte-level
pattern takes the space with it, the word-level one drops it. So a text is cut
around these words, each distinct piece is encoded once by the ``tokenizers``
library, and the ids of the pieces are concatenated. The ids are those of
encoding the whole text (``tests/llm/test_tokens.py`` holds them against it).
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

_LETTERS = "[A-Za-zÀ-ÖØ-öø-ɏ]+"
_WORD = re.compile(rf"( {_LETTERS}(?=[ .,\n]|\Z)|(?<=[A-Za-z.,]\n){_LETTERS}(?=[ .,\n]|\Z))")


class _Numbered(dict):
    """Numbers new keys as they are asked for and lists them in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self.fresh.append(key)
        number = self[key] = len(self)
        return number


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (the installed package holds them)."""
    import public_tokenizers
    return public_tokenizers.path(name)


class ChunkEncoder:
    """Encodes batches of texts; one instance per worker process.

    ``memo_chunks`` bounds the memory of the memo (distinct pieces kept); a
    full memo forgets the pieces that were asked for once only, and the rarer
    ones of the others beyond half the bound. That costs time and changes nothing
    else.
    """

    def __init__(self, path: str, memo_chunks: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        # a word's ids begin with a token that holds its space, or end with one
        # that holds the end of the word; so words can be encoded many at a time
        suffix = getattr(self._tok.model, "end_of_word_suffix", None)
        vocabulary = self._tok.get_vocab(with_added_tokens=True)
        self._edge = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._edge[[i for t, i in vocabulary.items() if (t.endswith(suffix) if suffix else t.startswith("\u0120"))]] = True
        self._edge_last = bool(suffix)
        self._limit = memo_chunks
        self._reset()

    def _reset(self) -> None:
        self._slot = _Numbered()
        self._flat = np.empty(1 << 16, np.uint32)
        self._ends, self._sizes, self._hits = np.zeros((3, 1 << 14), np.int64)
        self._used = 0

    def _shrink(self) -> None:
        """Keep the pieces that were asked for again, half the bound at most."""
        hits = self._hits[:len(self._slot)]
        keep = np.flatnonzero(hits > 1)
        most = self._limit // 2
        if len(keep) > most:
            keep = np.sort(keep[np.argsort(-hits[keep], kind="stable")[:most]])
        size = self._sizes[keep]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        flat = self._flat[np.arange(total) + np.repeat(self._ends[keep] - ends, size)]
        pieces = list(self._slot)
        self._reset()
        self._slot.update((pieces[k], n) for n, k in enumerate(keep.tolist()))
        room = 1 << 14
        while room <= len(keep):
            room *= 2
        self._ends, self._sizes, self._hits = np.zeros((3, room), np.int64)
        self._ends[:len(keep)], self._sizes[:len(keep)] = ends, size
        self._flat = np.resize(flat, max(1 << 16, 2 * total)) if total else self._flat
        self._used = total

    def _encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the number of each."""
        found = [e.ids for e in self._tok.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter(chain.from_iterable(found), np.uint32),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _encode_words(self, words: list[str], group: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """``_encode_all`` of spaced words, many words in one text."""
        ids, _ = self._encode_all(["".join(words[lo:lo + group]) for lo in range(0, len(words), group)])
        edges = np.flatnonzero(self._edge[ids])
        bounds = np.concatenate(([0], edges + 1)) if self._edge_last else np.append(edges, len(ids))
        if len(bounds) != len(words) + 1:
            return self._encode_all(words)
        return ids, np.diff(bounds)

    def _learn(self) -> None:
        """Encode the pieces that were numbered since the last call."""
        fresh = self._slot.fresh
        if not fresh:
            return
        spaced = np.fromiter((p[0] == " " and _WORD.fullmatch(p) is not None for p in fresh), bool, len(fresh))
        size = np.empty(len(fresh), np.int64)
        parts = []
        for kind, encode in ((True, self._encode_words), (False, self._encode_all)):
            ids, size[spaced == kind] = encode([p for p, s in zip(fresh, spaced) if s == kind])
            parts.append(ids)
        # ids lie by kind, so a piece's place is the end of those of its kind before it
        ends = np.where(spaced, np.cumsum(size * spaced), len(parts[0]) + np.cumsum(size * ~spaced)) + self._used
        at, end = len(self._slot) - len(fresh), self._used + len(parts[0]) + len(parts[1])
        if end > len(self._flat):
            self._flat = np.resize(self._flat, 2 * end)
        if at + len(fresh) > len(self._ends):
            room = np.zeros(at + 2 * len(fresh), np.int64)
            self._ends, self._sizes, self._hits = (np.concatenate((x[:at], room[at:])) for x in (self._ends, self._sizes, self._hits))
        self._flat[self._used:end] = np.concatenate(parts)
        self._ends[at:at + len(fresh)] = ends
        self._sizes[at:at + len(fresh)] = size
        self._used = end
        fresh.clear()

    @staticmethod
    def _chunks(text: str) -> list[str]:
        return list(filter(None, _WORD.split(text)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        chunks: list[str] = []
        counts = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self._chunks(text)
            counts[i] = len(parts)
            chunks += parts
        if not chunks:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        if len(self._slot) > self._limit:
            self._shrink()
        at = np.fromiter(map(self._slot.__getitem__, chunks), np.int64, len(chunks))
        self._learn()
        self._hits[:len(self._slot)] += np.bincount(at, minlength=len(self._slot))
        size = self._sizes[at]
        ends = np.cumsum(size)
        index = np.arange(int(ends[-1])) + np.repeat(self._ends[at] - ends, size)
        last = np.cumsum(counts)
        upto = np.concatenate(([0], ends))
        return self._flat[index], upto[last] - upto[last - counts]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: fixed values: the parts of a word-level file that ``WordEncoder`` stands for
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: letters that lower-case to one letter and that normalisation leaves alone
_PLAIN_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_NOT_PLAIN = re.compile(rf"[^\x20-\x7e\t\n\r{_PLAIN_LETTERS}¡-©«¬®¯°±´¶·»¿‐-‧‰€]")
_PIECES = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_PLAIN_LETTERS}]+|[0-9]|[^ \t\n\r0-9{_PLAIN_LETTERS}]+")


class WordEncoder:
    """Encodes texts by a word-level BPE file; one instance per worker process.

    Merges never cross white space, so a text beyond ``most`` characters is cut
    at spaces or line ends; a word longer than that goes to the library whole.
    """

    def __init__(self, path: str, most: int = 1 << 18):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, pre = file["model"], (file["pre_tokenizer"] or {}).get("pretokenizers", [])
        plain = [{"type": "Split", "pattern": {"Regex": _WORD_PATTERN}, "behavior": "Removed", "invert": True},
                 {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        if (model["type"] != "BPE" or not model["end_of_word_suffix"] or pre != plain
                or (file["normalizer"] or {}).get("normalizers") != _NORMALIZERS):
            raise ValueError(f"not a word-level BPE file: {path}")
        mark, letters = model["end_of_word_suffix"], byte_letters()
        names = {t["content"] for t in file["added_tokens"]}
        ranks = {}
        for token, number in model["vocab"].items():
            if token not in names:
                stem = token.removesuffix(mark)
                ranks[bytes(map(letters.__getitem__, stem)) + b" " * (stem != token)] = number
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [model["vocab"]["".join(p)] for p in pairs]
        ends = [number for token, number in ranks.items() if len(token) == 2 and token.endswith(b" ")]
        # a letter and its end mark are one symbol before any merge
        if order != sorted(order) or min(order) <= max(n for n in ends if n not in set(order)):
            raise ValueError("ids are not in the order of the merges")
        self._fast = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        self._most = most

    def _stretches(self, text: str) -> list[str]:
        """``text`` in parts of about ``most`` characters, ended by a space."""
        parts, lo = [], 0
        while len(text) - lo > self._most:
            hi = max(text.rfind(" ", lo, lo + self._most), text.rfind("\n", lo, lo + self._most))
            if hi < lo:
                found = [k for k in (text.find(" ", lo + self._most), text.find("\n", lo + self._most)) if k >= 0]
                hi = min(found, default=len(text) - 1)
            parts.append(text[lo:hi + 1])
            lo = hi + 1
        parts.append(text[lo:])
        return parts

    def _ids(self, text: str) -> np.ndarray:
        if _NOT_PLAIN.search(text) or len(text) > self._most + 1:
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self._fast.encode_to_numpy(" ".join(_PIECES.findall(text.lower())) + " ", disallowed_special=())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        parts, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            for part in self._stretches(text):
                # lines apart, so that an unusual character costs its line only
                lines = part.split("\n") if _NOT_PLAIN.search(part) else [part]
                own = [self._ids(x) for x in lines]
                parts += own
                sizes[k] += sum(map(len, own))
        return np.concatenate(parts).astype(np.uint32, copy=False), sizes


def text_encoder(path: str) -> WordEncoder | ChunkEncoder:
    """The encoder for a vocabulary file."""
    try:
        return WordEncoder(path)
    except (ValueError, KeyError):
        return ChunkEncoder(path)


def with_end_ids(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``ids`` with ``end_id`` after each text, and the ends of the texts."""
    ends = np.cumsum(sizes + 1)
    out = np.empty(len(ids) + len(sizes), np.uint32)
    is_end = np.zeros(len(out), bool)
    is_end[ends - 1] = True
    out[is_end] = end_id
    out[~is_end] = ids
    return out, ends


def slices(texts: list[str], most_chars: int = 2_000_000):
    """Ranges of ``texts`` of about ``most_chars`` characters, one text at least."""
    lo = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most_chars:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)
