"""Exact token counts at every prefix of a text, by dynamic programming over prefixes of its words."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from comboscope.llm import words as W
from comboscope.llm.packing import _byte_symbols

#: Words, and parts of words, whose counts a Python worker remembers; others are counted again when they return.
REMEMBERED = 800_000
_CHUNK = 12 << 20


class PrefixCounter:
    """Token counts of all prefixes under a BPE vocabulary with word ends, as its library encodes them.

    The last token of an encoding is the only vocabulary entry that ends there and stays apart from
    the last token of what stands before it, so one pass over a word gives the encodings of all its prefixes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.parts = regex.compile(split["pattern"]["Regex"]).findall
        symbols = {b: c for c, b in _byte_symbols().items()}
        self.symbol = [symbols[b] for b in range(256)]
        self.longest: dict[str, int] = {}  # by the last symbols of a token
        for token in self.vocab:
            inner = token.removesuffix(self.end) or token
            tail = inner[-2:] + token[len(inner):]
            self.longest[tail] = max(self.longest.get(tail, 0), len(inner))
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, int] = {}
        self.known_parts: dict[str, int] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(pairwise(symbols)))
            if best == 1 << 60:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _stays(self, before: str, token: str) -> bool:
        """Whether the encoding of both together is just these two."""
        key = (before, token)
        found = self.apart.get(key)
        if found is None:
            if len(self.apart) >= 2_000_000:
                self.apart.clear()
            whole = self._symbols(before) + self._symbols(token)
            found = self.apart[key] = self._merged(whole) == ([before, token] if before else [token])
        return found

    def _last(self, part: str, j: int, tail: str, last: list[str]) -> tuple[str, int]:
        vocab, apart = self.vocab, self.apart
        for i in range(max(0, j - self.longest.get(part[max(j - 2, 0) : j] + tail, 1)), j):
            token = part[i:j] + tail
            if token in vocab:
                ok = apart.get((last[i], token))
                if ok or ok is None and self._stays(last[i], token):
                    return token, i
        raise ValueError(f"no token ends at {j} of {part!r}")

    def part_counts(self, part: str) -> list[int]:
        """Counts of the prefixes of one part (byte symbols), each as a part of its own."""
        last, count, out = [""], [0], []
        for j in range(1, len(part) + 1):
            out.append(count[self._last(part, j, self.end, last)[1]] + 1)
            token, i = self._last(part, j, "", last)
            last.append(token)
            count.append(count[i] + 1)
        return out

    def _learn(self, parts: list[str]) -> dict[str, int]:
        """Counts of whole parts. In sorted order a part goes on from the prefix it shares with the one before."""
        found, last, count, before = {}, [""], [0], ""
        find, end = self._last, self.end
        for coded, part in sorted((self._coded(p), p) for p in parts):
            n, at = len(coded), 0
            most = min(n, len(last)) - 1
            while at < most and coded[at] == before[at]:
                at += 1
            del last[at + 1 :], count[at + 1 :]
            for j in range(at + 1, n):
                token, i = find(coded, j, "", last)
                last.append(token)
                count.append(count[i] + 1)
            found[part] = count[find(coded, n, end, last)[1]] + 1
            before = coded
        return found

    def _coded(self, part: str) -> str:
        return part if part.isascii() and part.isprintable() else "".join(self.symbol[b] for b in part.encode())

    def _normal(self, word: str) -> str:
        # Latin letters below U+0250 need no composing and have one lower case each, but for dotted I
        if word.isascii() or max(word) < "\u0250" and "\u0130" not in word:
            return word.lower()
        return self.library.normalizer.normalize_str(word)

    def _split(self, word: str) -> list[str]:
        """The parts of text without ASCII white space; special strings stay as they are."""
        if "<|" not in word:
            return self.parts(self._normal(word))
        out = []
        for piece in regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", word):
            out += [piece] if piece in self.special else self.parts(self._normal(piece))
        return out

    def words(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; a word is text without ASCII white space."""
        known, parts = self.known, self.known_parts
        fresh = {w: self._split(w) for w in words if w not in known}
        new = self._learn({p for ps in fresh.values() for p in ps if p not in parts and p not in self.special})
        extra = new | {t: 1 for t in self.special}
        totals = {w: sum(parts[p] if p in parts else extra[p] for p in ps) for w, ps in fresh.items()}
        out = np.fromiter((known[w] if w in known else totals[w] for w in words), np.int64, len(words))
        for memory, more in ((known, totals), (parts, new)):
            memory.update(islice(more.items(), max(0, REMEMBERED - len(memory))))
        return out

    def word(self, word: str) -> int:
        return int(self.words([word])[0])

    def prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, by characters: 1, 2, ... all."""
        normal = self._normal(word)
        letters = "<|" not in word and len(normal) == len(word) and all(len(self._normal(c)) == 1 for c in word)
        parts = self.parts(normal)
        if not letters or "".join(parts) != normal or any(p[0] == "'" and len(p) > 1 and p[1].isalpha() for p in parts):
            return [self.word(word[:k]) for k in range(1, len(word) + 1)]
        out, before = [], 0
        for part in parts:
            counts, at = self.part_counts(self._coded(part)), 0
            for c in part:
                at += len(c.encode())
                out.append(before + counts[at - 1])
            before += counts[-1]
        return out

    def ends(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Tokens of each word of all texts in order, where each text's words begin, and the words."""
        flat, offsets = W.split(texts)
        coded = flat.dictionary_encode()
        table = self.words(coded.dictionary.to_pylist())
        return table[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64), offsets, flat

    def fitting(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix with at most ``budget`` tokens, from the stored counts."""
        counts, _, flat = self.ends(pa.array([text], pa.large_string()))
        sums = np.cumsum(counts)
        whole = int(np.searchsorted(sums, budget, side="right"))
        if whole == len(sums):
            return len(text.encode())
        before = int(sums[whole - 1]) if whole else 0
        raw, at = text.encode(), 0
        for k, word in enumerate(flat[: whole + 1].to_pylist()):
            code = word.encode()
            at = raw.index(code, at) + len(code) * (k < whole)
        word = flat[whole].as_py()
        inside = [k for k, n in enumerate(self.prefixes(word), 1) if before + n <= budget]
        return at + (len(word[: inside[-1]].encode()) if inside else 0)


@lru_cache(maxsize=1)
def _counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _counts(path: str, limit: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for rows in W.chunks(batches, "text", _CHUNK):
            counts, offsets, _ = counter.ends(rows["text"])
            total = np.concatenate([[0], np.cumsum(counts)])[offsets]
            n = np.diff(total)
            size = pc.fill_null(pc.binary_length(rows["text"]), 0).cast(pa.int64())
            fit = size.to_numpy().copy()
            for i in np.nonzero(n > limit)[0]:
                fit[i] = counter.fitting(rows["text"][int(i)].as_py(), limit)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], size, pa.array(n), pa.array(n > limit), pa.array(fit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"])
    return scan


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit, and fit_bytes, the longest prefix with at most ``limit`` tokens.

    Counts of a word's prefixes come from one pass over it; those of a text add up over its words, as white
    space ends a part and leaves no token. Words that return are looked up. Null and empty texts have no
    tokens; null and repeated ids keep their rows; other columns are ignored; nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_counts(vocabulary, limit), f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long")
