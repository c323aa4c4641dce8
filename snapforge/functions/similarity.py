"""One string against many at once: the same scores as functions.udfs gives for pairs, over arrays.

The longest common subsequence of a query of up to 64 characters with every choice is found with one word of bits a choice, a
character of all choices at a time. Choices that a length or a bag of characters rules out are never compared.
"""

from __future__ import annotations

import numpy as np

from .udfs import common_subsequence, places, token_set_ratio

WORD = 64
#: A token that more choices hold is frequent; classes of as many members are compared by words of bits, so many members of each first.
FREQUENT = LARGE = FIRST = 32
#: Characters of classes, and classes of plans, that are kept for the next query.
KEPT_CODES, KEPT_PLANS = 16 << 20, 1 << 20


def subsequences(query: str, letters: dict[str, int], codes: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of query, of at most WORD characters, with each column of codes, that is of numbers as letters has them (0: none)."""
    bits = np.zeros(len(letters) + 1, np.uint64)
    for i, c in enumerate(query):
        if c in letters:
            bits[letters[c]] |= np.uint64(1 << i)
    row = np.full(codes.shape[1], np.uint64((1 << 64) - 1))
    for line in codes:
        own = bits[line] & row
        row = (row + own) | (row - own)
    return len(query) - np.bitwise_count(row & np.uint64((1 << len(query)) - 1)).astype(np.int64)


class Choices:
    """Strings ordered by length, longest first, as arrays of character numbers."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(texts))))}
        #: The j-th characters of all choices that have one, 0 for those that don't.
        self.codes = np.zeros((int(self.sizes[0]) if len(texts) else 0, len(texts)), np.int32)
        for place, k in enumerate(self.order.tolist()):
            self.codes[: len(texts[k]), place] = [self.letters[c] for c in texts[k]]

    def common(self, query: str, start: int, end: int) -> np.ndarray:
        """Length of the longest common subsequence of query with each choice from start to end in order."""
        if len(query) > WORD:
            where = places(query)
            return np.array([common_subsequence(where, len(query), self.texts[k]) for k in self.order[start:end]], np.int64)
        return subsequences(query, self.letters, self.codes[: int(self.sizes[start]) if end > start else 0, start:end])

    def best(self, query: str, least: int) -> tuple[int, int] | None:
        """(which choice, score) of the best ratio that reaches least; of equal ones the first."""
        n = len(query)
        if not n or not self.texts:
            return None
        able = np.flatnonzero(200 * np.minimum(n, self.sizes) >= (least - 0.5) * (n + self.sizes))
        if not able.size:
            return None
        start, end = int(able[0]), int(able[-1]) + 1  # between the longest and the shortest that can reach it, all can
        scores = np.rint(200 * self.common(query, start, end) / (n + self.sizes[start:end])).astype(np.int64)
        top = int(scores.max())
        return (int(self.order[start:end][scores == top].min()), top) if top >= least else None


class TokenSets:
    """Strings as sets of tokens, in classes of equal frequent tokens, number of tokens and letters.

    A choice that shares a token that isn't frequent with the query is compared by itself; there are few. Of all others a class has
    the same tokens in common with the query and the same lengths, so what the lengths allow is found once a class, and once for
    all queries of the same frequent tokens and lengths. Members of large classes are compared by words of bits, some of
    each class first, as one that reaches the score is enough; bags of characters rule out those of small ones.
    """

    def __init__(self, texts: list[str]):
        self.sets = [s for s in dict.fromkeys(frozenset(t.split()) for t in dict.fromkeys(texts)) if s]
        holders: dict[str, list[int]] = {}
        for k, s in enumerate(self.sets):
            for t in s:
                holders.setdefault(t, []).append(k)
        self.rare = {t: ks for t, ks in holders.items() if len(ks) <= FREQUENT}
        self.frequent = frozenset(holders.keys() - self.rare.keys())
        classes: dict[tuple, list[int]] = {}
        for k, s in enumerate(self.sets):
            classes.setdefault((s & self.frequent, len(s), sum(map(len, s))), []).append(k)
        self.members = [np.array(ks) for ks in classes.values()]
        self.of = np.empty(len(self.sets), np.int64)
        for c, ks in enumerate(self.members):
            self.of[ks] = c
        self.population = np.fromiter(map(len, self.members), np.int64, len(classes))
        self.tokens = np.fromiter((c[1] for c in classes), np.int64, len(classes))
        self.letters = np.fromiter((c[2] for c in classes), np.int64, len(classes))
        inside: dict[str, list[int]] = {}
        for c, (frame, *_) in enumerate(classes):
            for t in frame:
                inside.setdefault(t, []).append(c)
        self.inside = {t: np.array(cs) for t, cs in inside.items()}
        self.alphabet = {c: i for i, c in enumerate([" ", *sorted(set("".join(holders)))], 1)}
        self.bags = np.zeros((len(self.sets), len(self.alphabet) + 1), np.int16)
        for k, s in enumerate(self.sets):
            self.bags[k] = self._bag("".join(s))
        self.plans: dict[tuple, tuple | None] = {}
        self.codes: dict[tuple, np.ndarray] = {}
        self.coded = 0

    def _bag(self, text: str) -> np.ndarray:
        return np.bincount([self.alphabet[c] for c in text if c in self.alphabet], minlength=len(self.alphabet) + 1).astype(np.int16)

    def _plan(self, shared_tokens: frozenset, n_tokens: int, n_letters: int, least: int) -> tuple | None:
        """None where the lengths alone reach least, else the large classes that can reach it, best first, and the small ones by tokens in common."""
        n, named = len(self.members), sorted(shared_tokens)
        count, letters, which = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, object if len(named) > 62 else np.int64)
        for bit, t in enumerate(named):
            cs = self.inside[t]
            count[cs] += 1
            letters[cs] += len(t)
            which[cs] += 1 << bit
        some = count > 0
        if (some & ((count == n_tokens) | (count == self.tokens))).any():
            return None if least <= 100 else ([], [])
        # lengths of the shared tokens, and of either side's own, each joined by spaces
        shared = np.where(some, letters + count - 1, 0)
        mine = n_letters - letters + n_tokens - count - 1
        theirs = self.letters - letters + self.tokens - count - 1
        if (np.rint(200 * shared / (2 * shared + 1 + np.minimum(mine, theirs)))[some] >= least).any():
            return None
        gap = some.astype(np.int64)  # the space behind the shared tokens
        total = 2 * (shared + gap) + mine + theirs
        most = 200 * (shared + gap + np.minimum(mine, theirs))
        held = lambda mask: frozenset(t for bit, t in enumerate(named) if mask >> bit & 1)
        able = most >= (least - 0.5) * total
        large = np.flatnonzero(able & (self.population >= LARGE) & (mine <= WORD))
        large = large[np.argsort(-most[large] / total[large], kind="stable")]
        able[large] = False
        small = []
        cs = np.flatnonzero(able)
        masks, group = np.unique(which[cs], return_inverse=True)
        for g, mask in enumerate(masks.tolist()):
            own = cs[group == g]
            small.append((held(mask), own, int((shared + gap)[own[0]]), int(count[own[0]]), total))
        return [(c, held(int(which[c])), int(shared[c] + gap[c]), int(total[c])) for c in large.tolist()], small

    def _rests(self, c: int, held: frozenset) -> np.ndarray:
        """A column of character numbers for each member of a class, without the tokens held; all are of one length."""
        if (made := self.codes.get((c, held))) is None:
            texts = [" ".join(sorted(self.sets[k] - held)) for k in self.members[c].tolist()]
            made = np.ascontiguousarray(np.array([[self.alphabet[x] for x in t] for t in texts], np.int32).reshape(len(texts), -1).T)
            if self.coded + made.size > KEPT_CODES:
                self.codes.clear()
                self.coded = 0
            self.codes[c, held] = made
            self.coded += made.size
        return made

    def near(self, query: str, least: int) -> bool:
        """Whether any choice's token set ratio with query reaches least."""
        own = frozenset(query.split())
        if not own or not self.sets:
            return False
        alone = {k for t in own for k in self.rare.get(t, ())}
        if any(token_set_ratio(query, " ".join(self.sets[k])) >= least for k in alone):
            return True
        key = (own & self.frequent, len(own), sum(map(len, own)), least)
        if key not in self.plans:
            if (len(self.plans) + 1) * len(self.members) > KEPT_PLANS:
                self.plans.clear()
            self.plans[key] = self._plan(*key)
        if (plan := self.plans[key]) is None:
            return True
        large, small = plan
        rest = {held: " ".join(sorted(own - held)) for held in {held for _, held, *_ in large} | {held for held, *_ in small}}
        for some in (slice(FIRST), slice(FIRST, None)):
            for c, held, fixed, total in large:
                codes = self._rests(c, held)[:, some]
                hit = np.rint(200 * (fixed + subsequences(rest[held], self.alphabet, codes)) / total) >= least
                if hit.any() and not alone.issuperset(self.members[c][some][hit].tolist()):
                    return True
        for held, cs, fixed, count, totals in small:
            chosen = np.zeros(len(self.members), bool)
            chosen[cs] = True
            ks = np.flatnonzero(chosen[self.of])
            spaces = np.minimum(len(own) - count, self.tokens[self.of[ks]] - count) - 1
            most = np.minimum(self._bag(rest[held].replace(" ", "")), self.bags[ks] - self._bag("".join(held))).sum(axis=1) + spaces
            total = totals[self.of[ks]]
            bound = 200 * (fixed + most) / total
            where = places(rest[held])
            for i in np.argsort(-bound, kind="stable").tolist():
                if bound[i] < least - 0.5:
                    break
                k = int(ks[i])
                common = common_subsequence(where, len(rest[held]), " ".join(sorted(self.sets[k] - held)))
                if k not in alone and round(200 * (fixed + common) / int(total[i])) >= least:
                    return True
        return False
