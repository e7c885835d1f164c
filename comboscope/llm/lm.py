"""Probability of text summed over all its segmentations into subwords, with weights learnt from the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W

#: Words of the highest training counts that every task looks up itself; all others are joined.
FREQUENT = 200_000
#: Rounds of expectation-maximisation over the piece weights.
ROUNDS = 2
#: Words whose lattices are computed at once.
_AT_ONCE = 5_000
#: Characters from which a word's lattice is summed by itself.
_LONG = 200
#: Expected uses, spread by the vocabulary's own scores, that every piece starts with.
PRIOR = 300.0
_CHUNK = 16 << 20
_START = "▁"


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[tuple[str, ...], np.ndarray]:
    """Pieces of a subword vocabulary file and first weights from their scores; byte pieces stand for characters without a piece.

    Scores of merge vocabularies are ranks; a rank is taken as a place in a Zipf distribution.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    names = tuple(model.id_to_piece(i) for i in ids)
    scores = np.array([model.get_score(i) for i in ids])
    likely = np.exp(scores) if scores.min() > -30 else 1 / (10 + np.abs(np.minimum(scores, 0)).clip(max=2 * len(ids)))
    byte = np.array([model.is_byte(i) for i in ids])
    likely[byte] = likely[~byte].min()
    return names, likely / likely.sum()


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLOT = np.uint64(64 - 20)


class Lattice:
    """Forward and backward sums over the segmentations of words, many words at a time."""

    def __init__(self, names: tuple[str, ...], weights: np.ndarray):
        plain = np.array([i for i, n in enumerate(names) if not (len(n) == 6 and n.startswith("<0x"))])
        sizes = np.array([len(names[i]) for i in plain])
        self.longest = int(sizes.max())
        h = np.zeros(len(plain), np.uint64)
        for n in np.unique(sizes):
            rows = np.nonzero(sizes == n)[0]
            h[rows] = self._prefixes([names[plain[i]] for i in rows], int(n))[0][n]
        with np.errstate(divide="ignore"):
            self.log = np.log(weights)
        # the first table has a piece in a slot; the others of that slot are looked up in a sorted list
        slot = (h >> _SLOT).astype(np.int64)
        _, first = np.unique(slot, return_index=True)
        self.hash, self.piece = np.zeros(1 << 20, np.uint64), np.full(1 << 20, -1, np.int32)
        self.hash[slot[first]], self.piece[slot[first]] = h[first], plain[first]
        more = np.setdiff1d(np.arange(len(h)), first)
        more = more[np.argsort(h[more])]
        self.clash = np.zeros(1 << 20, bool)
        self.clash[slot[more]] = True
        self.more_hash, self.more_piece = np.append(h[more], np.uint64(0)), np.append(plain[more], -1)
        self.more_hash[-1] = np.iinfo(np.uint64).max
        self.byte = [names.index(f"<0x{b:02X}>") for b in range(256)]
        self.log_byte = float(np.mean(self.log[self.byte]))

    @staticmethod
    def _prefixes(words: list[str], n: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Hash sums of the prefixes of words of n characters, and the characters by place."""
        raw = _codes(words).reshape(len(words), n).T.copy()
        sums, power = [np.zeros(len(words), np.uint64)], 1
        for row in raw:
            sums.append(sums[-1] + W.mixed(row) * np.uint64(power))
            power = power * _BASE % (1 << 64)
        return sums, raw

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        slot = (h >> _SLOT).astype(np.int64)
        out = np.where(self.hash[slot] == h, self.piece[slot], -1)
        again = np.nonzero(self.clash[slot])[0]
        if len(again):
            at = np.searchsorted(self.more_hash[:-1], h[again])
            hit = self.more_hash[at] == h[again]
            out[again[hit]] = self.more_piece[at[hit]]
        return out

    def _arcs(self, words: list[str], n: int) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]]:
        """(to, [(from, piece or -1, log weight)], bytes of the last character) for words of n characters, the word mark first."""
        sums, raw = self._prefixes(words, n)
        inverse = [np.uint64(pow(_INVERSE, i, 1 << 64)) for i in range(n)]
        log = np.append(self.log, -np.inf)  # piece -1 has the last entry
        for j in range(1, n + 1):
            arcs, last = [], raw[j - 1]
            width = 1 + (last > 0x7F).astype(int) + (last > 0x7FF) + (last > 0xFFFF)
            for i in range(max(0, j - self.longest), j):
                piece = self._find((sums[j] - sums[i]) * inverse[i])
                if i == j - 1:
                    arcs.append((i, piece, np.where(piece >= 0, log[piece], self.log_byte * width)))
                elif piece.max() >= 0:
                    arcs.append((i, piece, log[piece]))
            yield j, arcs, width

    def _groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, list[str], int]]:
        sizes = np.array([len(w) + 1 for w in words])
        order = np.argsort(sizes, kind="stable")
        for part in np.split(order, np.nonzero(np.diff(sizes[order]))[0] + 1):
            for k in range(0, len(part), _AT_ONCE):
                rows = part[k : k + _AT_ONCE]
                yield rows, [_START + words[i] for i in rows], int(sizes[rows[0]])

    def log_probability(self, words: list[str]) -> np.ndarray:
        """Natural logarithm of each word's probability."""
        out = np.zeros(len(words))
        for rows, group, n in self._groups(words) if words else ():
            if n >= _LONG:
                out[rows] = [self._forward(n, *self._all_arcs(w)[:3])[-1] for w in group]
                continue
            forward = np.zeros((n + 1, len(group)))
            for j, arcs, _ in self._arcs(group, n):
                forward[j] = _log_sum([forward[i] + log for i, _, log in arcs])
            out[rows] = forward[n]
        return out

    def _all_arcs(self, word: str) -> tuple[np.ndarray, ...]:
        """(from, to, log weight, piece or -1, bytes of the last character) of one word, ordered by where they end."""
        raw, n = _codes([word]), len(word)
        power, inverse = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        power[0] = inverse[0] = 1
        power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mixed(raw) * power)])
        width = 1 + (raw > 0x7F).astype(int) + (raw > 0x7FF) + (raw > 0xFFFF)
        log, parts = np.append(self.log, -np.inf), []
        for size in range(1, min(self.longest, n) + 1):
            piece = self._find((sums[size:] - sums[:-size]) * inverse[: n - size + 1])
            at = np.arange(n) if size == 1 else np.nonzero(piece >= 0)[0]
            piece = piece[at]
            weight = np.where(piece >= 0, log[piece], self.log_byte * width[at]) if size == 1 else log[piece]
            parts.append((at, at + size, weight, piece, width[at + size - 1]))
        begin, end, weight, piece, wide = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((begin, end))
        return begin[order], end[order], weight[order], piece[order], wide[order]

    @staticmethod
    def _forward(n: int, begin: np.ndarray, end: np.ndarray, weight: np.ndarray) -> list[float]:
        """log of the summed ways to each place; arcs are ordered by their end, of which every place has one."""
        sums, here, terms = [0.0], 1, []
        exp, log = math.exp, math.log
        for i, j, w in zip([*begin.tolist(), 0], [*end.tolist(), n + 1], [*weight.tolist(), 0.0], strict=True):
            if j != here:
                most = max(terms)
                sums.append(most + log(sum([exp(t - most) for t in terms])))
                here, terms = j, []
                if j > n:
                    break
            terms.append(sums[i] + w)
        return sums

    def _expected_alone(self, word: str, out: np.ndarray, times: float) -> None:
        """Adds ``times`` the expected uses of pieces in one word."""
        begin, end, weight, piece, width = self._all_arcs(word)
        n = len(word)
        forward = np.array(self._forward(n, begin, end, weight))
        turned = np.lexsort((-end, n - begin))  # the same sums from the word's end
        backward = np.array(self._forward(n, n - end[turned], n - begin[turned], weight[turned]))[::-1]
        share = times * np.exp(forward[begin] + weight + backward[end] - forward[n])
        known = piece >= 0
        out += np.bincount(piece[known], share[known], len(out))
        out[self.byte] += (share[~known] * width[~known]).sum() / 256

    def expected(self, words: list[str], size: int, times: np.ndarray | None = None) -> np.ndarray:
        """How often each piece is used, expected over the segmentations of the words, each of which counts ``times``."""
        out, times = np.zeros(size), np.ones(len(words)) if times is None else times
        for rows, group, n in self._groups(words) if words else ():
            if n >= _LONG:
                for w, t in zip(group, times[rows].tolist(), strict=True):
                    self._expected_alone(w, out, t)
                continue
            steps = list(self._arcs(group, n))
            forward = np.zeros((n + 1, len(group)))
            for j, arcs, _ in steps:
                forward[j] = _log_sum([forward[i] + log for i, _, log in arcs])
            backward: list[list[np.ndarray]] = [[] for _ in range(n + 1)]
            for j, arcs, width in reversed(steps):
                after = _log_sum(backward[j]) if j < n else np.zeros(len(group))
                for i, piece, log in arcs:
                    way = log + after
                    backward[i].append(way)
                    share = np.exp(forward[i] + way - forward[n]) * times[rows]
                    known = piece >= 0
                    out += np.bincount(piece[known], share[known], size)
                    if i == j - 1 and not known.all():
                        out[self.byte] += (share[~known] * width[~known]).sum() / 256
                backward[j] = []
        return out


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    """log of the summed exponentials; -inf where there is no term."""
    if len(terms) == 1:
        return terms[0]
    if not terms:
        return np.array(-np.inf)
    x = np.stack(terms)
    most = x.max(0)
    safe = np.maximum(most, -1e300)
    return most + np.log(np.maximum(np.exp(x - safe).sum(0), 1e-300))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if n:
        yield pa.concat_batches(held)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in W.chunks(batches, "text", _CHUNK):
        flat, offsets = W.split(pc.ascii_lower(pc.fill_null(rows["text"], "").cast(pa.large_string())))
        coded = flat.dictionary_encode()
        learnt = np.repeat(rows["learnt"].to_numpy(zero_copy_only=False), np.diff(offsets))
        n = np.bincount(coded.indices.to_numpy()[learnt], minlength=len(coded.dictionary))
        words = coded.dictionary.cast(pa.string())
        for at in range(0, len(words), 100_000):
            yield pa.RecordBatch.from_arrays([words.slice(at, 100_000), pa.array(n[at : at + 100_000])], ["word", "n"])


def _expectation(names: tuple[str, ...], weights: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = Lattice(names, weights), np.zeros(len(names))
        for batch in _gathered(batches):
            total += lattice.expected(batch["word"].to_pylist(), len(names), batch["n"].to_numpy().astype(float))
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])
    return scan


def learn_weights(words: DataFrame, path: str, ends: int = 0, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Probabilities of the pieces, and of an end, fitted to ``words`` (columns ``word``, ``n``) and the number of ends.

    Piece weights start from the vocabulary's scores and are refined by expectation-maximisation over
    all segmentations. What tasks send is bounded by the vocabulary.
    """
    names, first = vocabulary(path)
    weights, end = first, 0.5 / (PRIOR + 0.5)
    for _ in range(rounds):
        used = words.select("word", "n").mapInArrow(_expectation(names, weights), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        total = PRIOR * first
        for piece, n in used:
            total[piece] += n
        weights = total / (total.sum() + ends + 0.5)
        end = (ends + 0.5) / (total.sum() + ends + 0.5)
    return weights, end


def _lattice_scores(names: tuple[str, ...], weights: np.ndarray):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(names, weights)
        for batch in _gathered(batches):
            yield pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.array(lattice.log_probability(batch["word"].to_pylist()))], ["word", "n", "lattice"])
    return scan


def _document_words(frequent):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, base, score, mixed, counted = frequent.value
        table = pa.array(known, pa.large_string())
        for rows in W.chunks(batches, "text", _CHUNK):
            flat, offsets = W.split(pc.ascii_lower(pc.fill_null(rows["text"], "").cast(pa.large_string())))
            coded = flat.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(rows.num_rows), np.diff(offsets))
            at = pc.fill_null(pc.index_in(coded.dictionary, table), -1).to_numpy()[code] if len(code) else np.zeros(0, np.int64)
            hot = at >= 0
            sums = [np.bincount(doc[hot], x[at[hot]], rows.num_rows) for x in (base, score, mixed, counted)]
            pairs, times = np.unique(doc[~hot] * len(coded.dictionary) + code[~hot], return_counts=True)
            owner, word = np.divmod(pairs, max(len(coded.dictionary), 1))
            n, zero = rows.num_rows, np.zeros(len(pairs))
            # a document's own sums travel under a name that no word can have
            label = pa.array([f" {r}" for r in rows["row"].to_pylist()], pa.string())
            row = np.concatenate([np.arange(n), owner])
            yield pa.RecordBatch.from_arrays([
                rows["row"].take(pa.array(row)), rows["doc_id"].take(pa.array(row)), rows["held_out"].take(pa.array(row)),
                pa.concat_arrays([label, coded.dictionary.take(pa.array(word)).cast(pa.string())]),
                pa.array(np.concatenate([np.zeros(n, np.int64), times])), pa.array(np.concatenate([np.diff(offsets), np.zeros(len(pairs), np.int64)])),
                pa.array(np.concatenate([sums[0], zero])), *(pa.array(np.concatenate([x, zero])) for x in sums[1:3]), pa.array(np.concatenate([sums[3], zero]).astype(np.int64))],
                ["row", "doc_id", "held_out", "word", "times", "n_words", "base", "score", "mixed", "n_known"])
    return scan


def score_documents(docs: DataFrame, held_out: Column, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score.

    Tokens are lower-cased words and one end. Rows that aren't ``held_out`` are learnt from. ``score`` is the
    probability of the whole text (words, each with the space before it, and the end) summed over all its segmentations
    into pieces of the vocabulary; the pieces' weights come from the vocabulary's scores, refined by expectation-maximisation
    over all words learnt from. ``base_score`` is the add-half word model, and ``mixed_score`` gives a word its discounted
    count plus the mass this frees times its lattice sum. All are log10.

    The most frequent words (a fixed number) are looked up in the tasks, all others by a join, each text's
    distinct words once. Null and empty texts are one end. Words of any length are summed whole, in time
    proportional to it. Without training rows the base is 0 for ends, and the vocabulary's own scores are the weights; an empty
    table gives an empty result. Null and repeated ids keep their rows, equal rows score alike; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = rows.select(F.col("text"), (~F.col("held_out")).alias("learnt")).mapInArrow(_word_counts, "word string, n long")
    counts = written(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    ends = rows.where(~F.col("held_out")).count()
    n, types, once, twice = counts.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    total, distinct = n + ends, types + (ends > 0)
    discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once and twice else 0.5

    names, _ = vocabulary(path)
    weights, end = learn_weights(counts.where("n > 0"), path, ends)
    free = discount * distinct / total if total else 1.0
    log10 = math.log(10)
    scored = counts.mapInArrow(_lattice_scores(names, weights), "word string, n long, lattice double")
    held = F.greatest(F.col("n") - F.lit(discount), F.lit(0.0)) / F.lit(float(max(total, 1)))
    # log of discounted share + free mass * lattice, without leaving double's range
    seen = F.log(F.greatest(held, F.lit(1e-300)))
    new = F.lit(math.log(free)) + F.col("lattice")
    high = F.when(held > 0, F.greatest(seen, new)).otherwise(new)
    mixed = F.when(held > 0, high + F.log1p(F.exp(F.least(seen, new) - high))).otherwise(new) / log10
    base = F.log10((F.col("n") + 0.5) / F.lit(total + 0.5 * (distinct + 1)))
    lexicon = written(scored.select("word", "n", base.alias("word_base"), (F.col("lattice") / log10).alias("word_score"), mixed.alias("word_mixed")), "lexicon")

    top = lexicon.where("n > 0").orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow().combine_chunks()
    frequent = rows.sparkSession.sparkContext.broadcast(  # FREQUENT words at most
        ([str(w) for w in top["word"].to_pylist()], top["word_base"].to_numpy(), top["word_score"].to_numpy(), top["word_mixed"].to_numpy(), np.ones(len(top))))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text").mapInArrow(
        _document_words(frequent), f"row long, doc_id {kind}, held_out boolean, word string, times long, n_words long, base double, score double, mixed double, n_known long")
    joined = found.join(lexicon, "word", "left")
    sums = joined.groupBy("row", "doc_id", "held_out").agg(
        F.sum("n_words").alias("n_words"),
        F.sum(F.col("n_known") + F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_known"),
        *(F.sum(F.col(c) + F.coalesce(F.col("times") * F.col(f"word_{c}"), F.lit(0.0))).alias(c) for c in ("base", "score", "mixed")))
    end_base = math.log10((ends + 0.5) / (total + 0.5 * (distinct + 1)))
    end_mixed = math.log10((ends - discount) / total) if ends else 0.0
    return sums.select("doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"), (F.col("n_known") + int(ends > 0)).alias("n_known"),
                       F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + end_base).alias("base_score"), (F.col("score") + math.log10(end)).alias("score"),
                       (F.col("mixed") + end_mixed).alias("mixed_score"))
