"""What tasks do with a batch of candidates and a slice of the benchmark, as arrays: terms, pruned scores, parts of profile matches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import profiles as P
from ..functions import tables as T

PARTS = ("skill", "domain", "reasoning", "modality", "locality", "duration", "answer_type", "source_prior")
TAGS = ("skill_tags", "domain_tags", "reasoning_tags", "modality_tags", "locality_tags")
#: Scores nearer than this may be equal once they are rounded to six digits.
MARGIN = 2e-6
#: Terms are scored by postings until the others cannot add more than this; then, if too many items are left, until the next.
TAILS = (0.2, 0.0)


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """Half away from zero, as SQL rounds."""
    return np.sign(x) * np.floor(np.abs(x) * 10.0**digits + 0.5) / 10.0**digits


def spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., as many of them as many[0], then those of first[1], ..."""
    return np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())


class Terms:
    """Numbers of words, and with `pairs` also of neighbouring words, each with an inverse document frequency."""

    def __init__(self, words: pa.Array, pairs: np.ndarray | None = None, idf: np.ndarray | None = None) -> None:
        """pairs: words as first * len(words) + second, ascending; idf of words, then of pairs."""
        self.words, self.pairs = words, pairs
        self.size = len(words) + (0 if pairs is None else len(pairs))
        self.idf = np.ones(self.size) if idf is None else idf

    def counted(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of each different known term of each row, ascending."""
        n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lists)), n)
        codes = pc.index_in(lists.flatten(), self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if self.pairs is not None:
            near = (codes[:-1] >= 0) & (codes[1:] >= 0) & (rows[:-1] == rows[1:])
            pair = codes[:-1][near] * len(self.words) + codes[1:][near]
            at = np.minimum(np.searchsorted(self.pairs, pair), max(0, len(self.pairs) - 1))
            known = self.pairs[at] == pair if len(self.pairs) else np.zeros(len(pair), bool)
            codes, rows = np.concatenate((codes, len(self.words) + at[known])), np.concatenate((rows, rows[:-1][near][known]))
        keys, tf = np.unique(rows[codes >= 0] * max(1, self.size) + codes[codes >= 0], return_counts=True)
        return keys // max(1, self.size), keys % max(1, self.size), tf

    def squares(self, lists: pa.ListArray) -> np.ndarray:
        """The squared norm of each row: over known terms where these are weighed, else over all words."""
        if self.pairs is not None:
            row, term, tf = self.counted(lists)
        else:
            n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            coded = pc.dictionary_encode(lists.flatten())
            kinds = max(1, len(coded.dictionary))
            key, tf = np.unique(np.repeat(np.arange(len(lists)), n) * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            row, term = key // kinds, None
        weight = tf * self.idf[term] if term is not None else tf.astype(float)
        return np.bincount(row, weight**2, minlength=len(lists))


def coded(lists: pa.ListArray, pairs: bool) -> tuple[pa.Array, np.ndarray | None]:
    """The different words of lists, and the pairs of neighbours among them."""
    words = pc.unique(lists.flatten())
    if not pairs:
        return words, None
    n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    rows, codes = np.repeat(np.arange(len(lists)), n), pc.index_in(lists.flatten(), words).to_numpy(zero_copy_only=False).astype(np.int64)
    return words, np.unique((codes[:-1] * len(words) + codes[1:])[rows[:-1] == rows[1:]])


@dataclass
class Row:
    """What a candidate needs of the slice: items and their similarities, among which are all that can be in the result."""

    items: np.ndarray
    semantic: np.ndarray
    scored: int


class Postings:
    """An inverted index of items with the largest weight of each term, and the items' own terms."""

    def __init__(self, terms: Terms, lists: pa.ListArray) -> None:
        self.terms, self.n = terms, len(lists)
        item, term, tf = terms.counted(lists)
        weight = tf * terms.idf[term]
        self.norm = np.sqrt(np.bincount(item, weight**2, minlength=self.n))
        self.own, self.own_weight, self.own_first = term, weight, np.searchsorted(item, np.arange(self.n + 1))
        order = np.argsort(term, kind="stable")
        self.item, self.weight, self.first = item[order], weight[order], np.searchsorted(term[order], np.arange(terms.size + 1))
        self.length = np.where(self.norm > 0, self.norm, 1.0)
        self.top = np.zeros(terms.size)  # the largest weight that a term has in an item of length 1
        np.maximum.at(self.top, term, weight / self.length[item])
        self._query = np.zeros(terms.size)

    def rows(self, lists: pa.ListArray, squares: np.ndarray, keep) -> Iterator[Row]:
        """keep(row, low, gap) tells which items can be in the result if similarities are between low and low + gap, a number or one for each."""
        row, term, tf = self.terms.counted(lists)
        weight, cuts, norm = tf * self.terms.idf[term], np.searchsorted(row, np.arange(len(lists) + 1)), np.sqrt(squares)
        for i in range(len(lists)):
            t, x = term[cuts[i] : cuts[i + 1]], weight[cuts[i] : cuts[i + 1]]
            if not len(t):
                found = np.nonzero(keep(i, np.zeros(self.n), 0.0))[0]
                yield Row(found, np.zeros(len(found)), 0)
                continue
            most = x * self.top[t]
            order = np.argsort(-most, kind="stable")
            t, x, most = t[order], x[order], most[order]
            # what the terms from each on can add: by their largest weights, or by their length and that of the item's other terms
            weights, lengths = np.cumsum(most[::-1])[::-1] / norm[i], np.sqrt(np.cumsum((x**2)[::-1])[::-1]) / norm[i]
            bound, dots, done, at = np.minimum(weights, lengths), np.zeros(self.n), np.zeros(self.n), 0
            left = np.append(np.cumsum((self.first[t + 1] - self.first[t])[::-1])[::-1], 0)
            for tail in TAILS:
                head = int(np.searchsorted(-bound, -tail, "left")) if tail else len(t)
                more = self._dots(t[at:head], x[at:head])
                dots, done, at = dots + more[0], done + more[1], head
                gap = np.minimum(weights[head], lengths[head] * np.sqrt(np.maximum(0.0, 1 - done / self.length**2))) if head < len(t) else 0.0
                found = np.nonzero(keep(i, dots / (norm[i] * self.length), gap))[0]
                if head == len(t) or len(found) * len(self.own) < self.n * left[head]:  # else reading on is cheaper than the examples' own terms
                    break
            dot = dots[found] if at == len(t) else self._completed(found, t, x)
            yield Row(found, np.where(dot > 0, dot / (norm[i] * self.length[found]), 0.0), len(found) if at < len(t) else self.n)

    def _dots(self, t: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of all items the dot product over these terms, and what these are of the item's squared length."""
        many = self.first[t + 1] - self.first[t]
        at = spread(self.first[t], many)
        item, weight = self.item[at], self.weight[at]
        return np.bincount(item, np.repeat(x, many) * weight, minlength=self.n), np.bincount(item, weight**2, minlength=self.n)

    def _completed(self, items: np.ndarray, t: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The dot products of these items, from their own terms."""
        self._query[t] = x
        many = self.own_first[items + 1] - self.own_first[items]
        at = spread(self.own_first[items], many)
        out = np.bincount(np.repeat(np.arange(len(items)), many), self._query[self.own[at]] * self.own_weight[at], minlength=len(items))
        self._query[t] = 0.0
        return out


class Vectors:
    """Vectors of items, of length 1; all of them are scored."""

    def __init__(self, lists: pa.ListArray) -> None:
        self.n = len(lists)
        own = [x or [] for x in lists.to_pylist()]
        width = max(map(len, own), default=0)
        self.matrix = np.array([x if len(x) == width else [0.0] * width for x in own], float).reshape(self.n, width)

    def rows(self, lists: pa.ListArray, squares: np.ndarray | None, keep) -> Iterator[Row]:
        for i, x in enumerate(lists.to_pylist()):
            semantic = self.matrix @ np.array(x, float) if x is not None and self.n else np.zeros(self.n)
            found = np.nonzero(keep(i, semantic, 0.0))[0]
            yield Row(found, semantic[found], self.n)


class Profiles:
    """The different profiles of items as arrays, and which one each item has. This is where the rules of a match are."""

    def __init__(self, column: pa.StructArray) -> None:
        rows = [(p["duration_bucket"] or "", p["answer_type"] or "", p["benchmark_name"] or "", *(tuple(p[k] or ()) for k in TAGS)) for p in column.to_pylist()]
        number: dict[tuple, int] = {}
        self.of = np.array([number.setdefault(r, len(number)) for r in rows], np.int64)
        kinds = list(number)
        self.duration, self.answer, self.name = (np.array([r[k] for r in kinds], object) for k in range(3))
        self.tags = {k: sorted({t for r in kinds for t in r[3 + j]}) for j, k in enumerate(TAGS)}
        self.held = {k: np.array([[t in r[3 + j] for t in self.tags[k]] for r in kinds], float).reshape(len(kinds), -1) for j, k in enumerate(TAGS)}
        self.size = {k: np.array([len(r[3 + j]) for r in kinds], float) for j, k in enumerate(TAGS)}

    @staticmethod
    def _has(lists: pa.ListArray, tags: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Rows by tags, and the number of tags of each row."""
        n = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
        out = np.zeros((len(lists), len(tags)))
        at = pc.index_in(lists.flatten(), pa.array(tags, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lists)), n)
        out[rows[at >= 0], at[at >= 0]] = 1
        return out, n.astype(float)

    def _table(self, own: np.ndarray, other: np.ndarray, rule) -> np.ndarray:
        """rule(benchmark's value, candidate's value) for all pairs, worked out once for each different pair."""
        a, i = np.unique(own.astype(str), return_inverse=True)
        b, j = np.unique(other.astype(str), return_inverse=True)
        return np.array([[rule(y, x) for y in b] for x in a], float).reshape(len(a), len(b))[i][:, j]

    def parts(self, p: pa.StructArray) -> dict[str, np.ndarray]:
        """Of each candidate with each different profile.

        Tags match by twice the common ones over all; modality by the benchmark's share that the candidate has; locality fully if both are local, or the benchmark is
        global and the candidate global or of several segments; duration by steps between buckets."""
        common, total, has = {}, {}, {}
        for k in TAGS:
            found, n = self._has(p.field(k), self.tags[k])
            common[k], total[k] = found @ self.held[k].T, n[:, None] + self.size[k]
        for tag in ("local", "global", "multi_segment"):
            has[tag] = self._has(p.field("locality_tags"), [tag])[0] > 0
        bench = lambda k, tag: (self.held[k][:, self.tags[k].index(tag)] > 0) if tag in self.tags[k] else np.zeros(len(self.name), bool)
        overlap = {k: np.where(common[k] == 0, 0.0, 2.0 * common[k] / np.maximum(total[k], 1)) for k in TAGS}
        none = lambda k: self.size[k][None, :] == 0
        place = bench("locality_tags", "global") & (has["global"] | has["multi_segment"]) | bench("locality_tags", "local") & has["local"]
        text = lambda k: np.array([x or "" for x in p.field(k).to_pylist()], object)
        family = text("source_family")
        prior = self._table(family, self.name, lambda b, c: T.PRIORS.get(b, {}).get(c, T.OTHER_PRIOR))
        for field, tag, families, more in P.BOOSTS:
            prior = prior + more * (np.isin(family, families)[:, None] & bench(field, tag))
        order, phrases = ("short", "medium", "long", "very_long"), ("short_phrase", "sentence")

        def duration(b: str, c: str) -> float:
            if P.UNKNOWN in (b, c):
                return 0.5
            gap = abs(order.index(b) - order.index(c)) if b in order and c in order else 9
            return 1.0 if b == c else {1: 0.65, 2: 0.25}.get(gap, 0.0)

        def answer(b: str, c: str) -> float:
            return 0.5 if P.UNKNOWN in (b, c) else 1.0 if b == c else 0.75 if b in phrases and c in phrases else 0.0

        return {
            "skill": overlap["skill_tags"],
            "domain": overlap["domain_tags"],
            "reasoning": overlap["reasoning_tags"],
            "modality": np.where(none("modality_tags"), 0.5, common["modality_tags"] / np.maximum(self.size["modality_tags"], 1)),
            "locality": np.where(none("locality_tags"), 0.5, np.where(place, 1.0, overlap["locality_tags"])),
            "duration": self._table(text("duration_bucket"), self.duration, duration),
            "answer_type": self._table(text("answer_type"), self.answer, answer),
            "source_prior": np.clip(prior, 0.0, 1.0),
        }


def blend(parts: dict[str, np.ndarray], weights: dict[str, float]) -> np.ndarray | float:
    """Weighted mean of the parts with a positive weight."""
    used = {k: w for k, w in weights.items() if w > 0 and k in parts}
    return sum(w * np.clip(parts[k], 0.0, 1.0) for k, w in used.items()) / sum(used.values()) if used else 0.0


class Slice:
    """A slice of the benchmark, items in order of their keys, and the result for batches of candidates."""

    def __init__(self, keys: pa.Array, index: Postings | Vectors, sources: np.ndarray, kinds: int, profiles: Profiles | None, weights: dict[str, float], n: int, digits: tuple[int, int]) -> None:
        """sources: the number of each item's source, under `kinds`; -1 for none."""
        self.keys, self.index, self.sources, self.kinds, self.profiles, self.weights, self.n, self.digits = keys, index, sources, kinds, profiles, weights, n, digits
        self.order = np.argsort(sources, kind="stable")
        held = sources[self.order]
        self.starts = np.nonzero(np.diff(held, prepend=-2))[0]
        self.block = np.zeros(len(held), np.int64)
        self.block[self.order] = np.cumsum(np.diff(held, prepend=-2) != 0) - 1

    def _wanted(self, low: np.ndarray, gap: np.ndarray | float, n: int, by_source: bool) -> np.ndarray:
        """Items that can be among the n best, or the best of their source."""
        high = low + gap
        keep = high >= np.partition(low, -n)[-n] - MARGIN if 0 < n < len(low) else np.full(len(low), n > 0)
        if by_source and len(low):
            keep |= high >= np.maximum.reduceat(low[self.order], self.starts)[self.block] - MARGIN
        return keep

    def rows(self, values: pa.ListArray, squares: np.ndarray | None, profile: pa.StructArray | None) -> pa.RecordBatch:
        """(matches, best, best_semantic, max_similarity, scored) of a batch."""
        parts = self.profiles.parts(profile) if self.profiles is not None else {}
        used = {k: w for k, w in self.weights.items() if w > 0 and (k in parts or k == "semantic")}
        share = used.get("semantic", 0.0) / sum(used.values()) if used else 0.0
        rest = sum((w * np.clip(parts[k], 0.0, 1.0) for k, w in used.items() if k in parts), np.zeros((len(values), 1))) / (sum(used.values()) or 1.0)

        def keep(i: int, low: np.ndarray, gap: np.ndarray | float) -> np.ndarray:
            low = np.clip(low, 0.0, 1.0)
            wanted = self._wanted(low, gap, 1 if parts else self.n, self.kinds > 0)
            return wanted | self._wanted(share * low + rest[i][self.profiles.of], share * gap, self.n, self.kinds > 0) if parts else wanted

        names = ["semantic", *(["adjusted", "profile_only", *PARTS] if parts else [])]
        found, sizes, top, scored = [], [], [], []
        best = np.zeros((2, len(values), self.kinds))
        for i, row in enumerate(self.index.rows(values, squares, keep)):
            semantic = rounded(np.clip(row.semantic, 0.0, 1.0), self.digits[0])
            columns = {"semantic": semantic}
            if parts:
                own = {k: parts[k][i][self.profiles.of[row.items]] for k in PARTS}
                columns["adjusted"] = rounded(blend(own | {"semantic": semantic}, self.weights), self.digits[1]) + 0.0 * semantic
                columns["profile_only"] = rounded(blend(own, self.weights), self.digits[1]) + 0.0 * semantic
                columns |= own
            score = columns.get("adjusted", semantic)
            first = np.lexsort((row.items, -score))[: self.n]
            found.append([row.items[first], *(columns[k][first] for k in names)])
            sizes.append(len(first))
            some = self.sources[row.items] >= 0
            for k, x in enumerate((score, semantic)):
                np.maximum.at(best[k, i], self.sources[row.items][some], x[some])
            top.append(semantic.max(initial=0.0))
            scored.append(row.scored)
        each = [np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in range(1 + len(names))]
        struct = pa.StructArray.from_arrays([self.keys.take(pa.array(each[0].astype(np.int64))), *map(pa.array, each[1:])], ["key", *names])
        matches = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), struct)
        lists = [pa.array(x.tolist(), pa.list_(pa.float64())) for x in best]
        return pa.record_batch([matches, *lists, pa.array(top, pa.float64()), pa.array(scored, pa.int64())], ["matches", "best", "best_semantic", "max_similarity", "scored"])
