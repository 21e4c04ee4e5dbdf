"""Token ids of a word-level BPE tokenizer file, with a bounded cache of whole words.

The tokenizer lower-cases, splits at white space and encodes every word on its own, so the
ids of a text are the ids of its words one after another. Words are encoded once (all new words of
a batch in one call) and remembered as little-endian 16-bit ids; a text is then a join of remembered
words. Purely alphabetic words go through ``tiktoken``, which runs the same merges of the same file
about ten times faster (used only if the file's merges are in id order and both libraries agree on
the file's own words); everything else goes through ``tokenizers``. Texts for which the cheap split is not
provably the library's own (anything beyond ASCII and the Latin-1 letters, control separators,
the special tokens' strings, runs of punctuation) take a slower, equally exact way.
"""

from __future__ import annotations

import os

import numpy as np

from aerostat.llm.common import resident

#: words kept per Python worker; when full, the cache starts anew (results are the same)
CACHE_WORDS = 300_000

# one byte-to-byte table: lower case for ASCII and for the letters U+00C0..U+00DE (second byte 80..9E after C3)
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
# classes for the check that no two punctuation marks touch: p punctuation, s ASCII space, a letter, digit or C3 pair, x other
_CLASS = bytes(
    ord("a") if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b == 0xC3 or 0x80 <= b <= 0xBF
    else ord("s") if b in (9, 10, 11, 12, 13, 32)
    else ord("p") if 33 <= b <= 126 else ord("x") for b in range(256))

def default_path() -> str:
    """The public 49k word BPE file of the installed package."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def worker_tokenizer(path: str) -> "WordTokenizer":
    """One tokenizer (and cache) per Python worker and file."""
    return resident(("words", path), lambda: WordTokenizer(path))


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab(with_added_tokens=True)
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("the vocabulary needs more than 16 bits")
        self.ends = np.zeros(1 << 16, bool)
        for piece, i in vocab.items():
            self.ends[i] = piece.endswith("</w>")
        self.cache: dict[bytes, bytes] = {}
        self.fast = self._same_merges(path)

    def _same_merges(self, path: str):
        """The file's merges for tiktoken (a word's end is the byte 0), or None if that could differ."""
        import json
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocab.get("".join(m), -1) for m in merges]
        if model.get("end_of_word_suffix") != "</w>" or ids != sorted(set(ids)):
            return None
        # the byte-level alphabet: printable bytes stand for themselves, the rest from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
        ranks = {}
        for piece, i in vocab.items():
            body = piece.removesuffix("</w>")
            ranks[bytes(byte[c] for c in body) + b"\0" * (body != piece)] = i
        fast = tiktoken.Encoding("words", pat_str=r"[^ ]+", mergeable_ranks=ranks, special_tokens={})
        words = [p[:-4] for p in vocab if p.endswith("</w>") and p[:-4].isascii() and p[:-4].isalpha() and p[:-4].islower()][::7]
        same = self.tok.encode(" ".join(words), add_special_tokens=False).ids == fast.encode_ordinary("\0 ".join(words) + "\0")
        return fast if same else None

    def _ids(self, words: list[str]) -> np.ndarray:
        if self.fast is not None:
            return self.fast.encode_to_numpy("\0 ".join(words) + "\0").astype("<u2")
        return np.array(self.tok.encode(" ".join(words), add_special_tokens=False).ids, dtype="<u2")

    def _encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    @staticmethod
    def _plain_words(raw: bytes) -> list[bytes] | None:
        """Lower-cased words of a text whose split is certain, else None."""
        kinds = raw.translate(_CLASS)
        if b"x" in kinds or b"\xc3\x97" in raw or b"\xc3\xb7" in raw:
            return None
        low = raw.translate(_LOWER)
        if b"pp" not in kinds:  # each mark stands alone, so it may be set apart: fewer distinct words
            low = low.replace(b",", b" , ").replace(b".", b" . ")
        elif b"<|" in raw:
            return None
        return low.split()

    def _learn(self, words: list[bytes]) -> None:
        if len(self.cache) + len(words) > CACHE_WORDS:
            self.cache.clear()
        texts = [w.decode() for w in words]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        for at in range(0, len(plain), 20_000):
            part = plain[at:at + 20_000]
            ids = self._ids([texts[i] for i in part])
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):  # never seen; keeps a foreign tokenizer file right
                for i in part:
                    self.cache[words[i]] = self._encode(texts[i])
                continue
            raw, last = ids.tobytes(), 0
            for i, cut in zip(part, (cuts * 2).tolist()):
                self.cache[words[i]] = raw[last:cut]
                last = cut
        rest = [i for i, t in enumerate(texts) if not (t.isalpha())]
        for i, e in zip(rest, self.tok.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            self.cache[words[i]] = np.array(e.ids, dtype="<u2").tobytes()

    def ids16(self, texts: list[bytes | None]) -> list[bytes]:
        """Per UTF-8 text its ids as little-endian 16-bit integers; a null text counts as empty."""
        split = [self._plain_words(t) if t else [] for t in texts]
        new = set().union(*[w for w in split if w is not None]).difference(self.cache)
        if new:
            if len(self.cache) + len(new) > CACHE_WORDS:
                self.cache.clear()
                new = set().union(*[w for w in split if w is not None])
            self._learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, w)) if w is not None else self._encode(t.decode())
                for w, t in zip(split, texts)]
