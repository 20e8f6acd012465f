"""Similar names without scoring all pairs.

Two tables are dealt into blocks of bounded size under their key columns, and every pair of blocks is one
task, so a hot key is split on both sides. In a task bounds rule most pairs out. What two texts have in
matching blocks are letters of both, and how many letters they share comes for all texts of a side at once from
one AND and a count of bits. It is also a common subsequence of both, and the length of the longest one comes, for what
the letters leave, from one pass of bit-parallel additions. Only pairs whose bounds reach what is asked for are scored, the
most promising first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import cached_property, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.normalize import fuzzy_key
from rosterline.functions.similarity import block_ratio, label_forms, ratio, token_sorted

#: Rows of the left and of the right side that meet in one task, on the average; the right side is what is searched.
SIDE_ROWS, OTHER_ROWS = 4_000, 50_000
#: Words of 64 bits that the letters of a text are counted in; letters without a bit count as shared.
LETTER_WORDS = 2
#: How far a search for the best goes down at a time, on the scale of 100.
STEP = 5.0

#: By kernel: the forms of a text that are compared, and the score of two texts as the best over their forms.
FORMS: dict[str, Callable[[str], tuple[str, ...]]] = {
    "ratio": lambda text: (text,),
    "sorted": lambda text: (text, token_sorted(text)),
    "key": lambda text: (fuzzy_key(text),),
    "label": label_forms,
    "district": lambda text: label_forms(text, "district"),
}


def _scores(kind: str) -> Callable[[tuple[str, ...], tuple[str, ...]], float]:
    if kind == "sorted":
        # both forms count unless the texts are empty or equal
        return lambda a, b: ratio(a[0], b[0]) if not a[0] or not b[0] or a[0] == b[0] else max(map(block_ratio, a, b))
    return lambda a, b: max(map(ratio, a, b)) if a[0] and b[0] else 0.0


class Texts:
    """Texts of one side, ready to be held against one text at a time."""

    def __init__(self, texts: Sequence[str]):
        self.texts = list(texts)
        self.size = np.array([len(t) for t in self.texts], np.int64)
        width = int(self.size.max(initial=1)) or 1
        points = np.array(self.texts, dtype=f"<U{width}").view(np.uint32).reshape(len(self.texts), width)
        letters, places = np.unique(points, return_inverse=True)
        #: one row per position in the texts, one column per text; 0 stands behind the end
        self.places = np.ascontiguousarray(places.reshape(points.shape).T.astype(np.min_scalar_type(len(letters))))
        self.letters = {chr(c): k for k, c in enumerate(letters.tolist()) if c}
        self.n_letters = len(letters)
        self.bits: dict[tuple[str, int], tuple[int, int]] = {}
        self.words = np.zeros((0, len(self.texts)), np.uint64)
        self.levels: dict[str, int] = {}
        self.scales: dict[int, np.ndarray] = {}

    def counted(self) -> Texts:
        """Gives every text one bit per letter and occurrence of it, the most common ones, as far as there is room."""
        if self.levels or not self.letters:
            return self
        found = []
        for c, k in self.letters.items():
            n = (self.places == k).sum(axis=0)
            self.levels[c] = int(n.max(initial=0))
            sizes = np.bincount(n, minlength=self.levels[c] + 1)[::-1].cumsum()[::-1]
            found += [(-int(sizes[level]), c, level) for level in range(1, self.levels[c] + 1)]
        found = sorted(found)[: 64 * LETTER_WORDS]
        self.bits = {(c, level): divmod(at, 64) for at, (_, c, level) in enumerate(found)}
        self.words = np.zeros((-(-len(found) // 64), len(self.texts)), np.uint64)
        for c in {c for _, c, _ in found}:
            n = (self.places == self.letters[c]).sum(axis=0)
            for level in range(1, self.levels[c] + 1):
                if (c, level) in self.bits:
                    word, bit = self.bits[c, level]
                    self.words[word] |= (n >= level).astype(np.uint64) << np.uint64(bit)
        return self

    def shared(self, text: str, which: np.ndarray | None = None) -> np.ndarray:
        """At least the number of letters that each text (or those of ``which``) has in common with ``text``, in any order."""
        self.counted()
        masks, more, seen = [0] * len(self.words), 0, {}
        for c in text:
            seen[c] = level = seen.get(c, 0) + 1
            if (c, level) in self.bits:
                word, bit = self.bits[c, level]
                masks[word] |= 1 << bit
            elif level <= self.levels.get(c, 0):
                more += 1
        n = len(self.texts) if which is None else len(which)
        total = np.full(n, min(more, 255), np.uint8) if len(text) < 256 - 64 * LETTER_WORDS else np.full(n, more, np.int64)
        for word, mask in zip(self.words, masks, strict=True):
            if mask:
                total += np.bitwise_count((word if which is None else word[which]) & np.uint64(mask))
        return total

    def quick_bounds(self, text: str, which: np.ndarray | None = None) -> np.ndarray:
        """As ``bounds``, by the letters alone, and rounded up."""
        size = self.size if which is None else self.size[which]
        if not text:
            return np.zeros(len(size), np.float32)
        if which is not None:
            return self.shared(text, which) * self._scale(len(text))[size]
        if len(text) not in self.scales:
            if len(self.scales) > 64:
                self.scales.clear()
            self.scales[len(text)] = self._scale(len(text))[size]
        return self.shared(text) * self.scales[len(text)]

    def _scale(self, length: int) -> np.ndarray:
        """By size of a text, what one letter that it shares with a text of ``length`` adds at most."""
        scale = (200.0 * (1 + 1e-6) / (np.arange(int(self.size.max(initial=0)) + 1) + length)).astype(np.float32)
        scale[0] = 0.0
        return scale

    def common(self, text: str, which: np.ndarray | None = None) -> np.ndarray:
        """At least the length of the longest common subsequence with each text (or those of ``which``); exact up to 64 characters."""
        places = self.places if which is None else self.places[:, which]
        total = np.zeros(places.shape[1], np.int64)
        for start in range(0, len(text), 64):
            part = text[start : start + 64]
            masks = np.zeros(self.n_letters, np.uint64)
            for k, c in enumerate(part):
                if c in self.letters:
                    masks[self.letters[c]] |= np.uint64(1 << k)
            open_bits = np.full(places.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF))
            for row in places:
                hit = open_bits & masks[row]
                open_bits = (open_bits + hit) | (open_bits - hit)
            whole = np.uint64((1 << len(part)) - 1)
            total += np.bitwise_count(~open_bits & whole)
        return total

    def bounds(self, text: str, which: np.ndarray | None = None) -> np.ndarray:
        """What the ratio with each text cannot exceed, to the last bit; 0 where either is empty."""
        size = self.size if which is None else self.size[which]
        if not text:
            return np.zeros(len(size))
        least = np.minimum(self.common(text, which), np.minimum(size, len(text)))
        return np.where(size > 0, 2.0 * least / (size + len(text)) * 100.0, 0.0)


class Side:
    """One side under a kernel: all forms of its texts. The kernels are not symmetric: texts of this side come second, or with ``first`` first."""

    def __init__(self, texts: Sequence[str], kind: str = "ratio", first: bool = False):
        score = _scores(kind)
        self.form, self.score = FORMS[kind], (lambda a, b: score(b, a)) if first else score
        self.forms = [self.form(t) for t in texts]
        self.each = [Texts([f[k] for f in self.forms]) for k in range(len(self.form("")))]
        #: for every form the first one whose texts have just the same letters
        self.alike = [next(j for j in range(k + 1) if j == k or all(sorted(f[j]) == sorted(f[k]) for f in self.forms)) for k in range(len(self.each))]

    def against(self, text: str) -> Against:
        return Against(self, text)


class Against:
    """One text held against a side; scores are worked out once per pair, and only where they are asked for."""

    def __init__(self, side: Side, text: str):
        self.side, self.own = side, side.form(text)
        self.known: dict[tuple[str, ...], float] = {}

    @cached_property
    def quick(self) -> np.ndarray:
        """What no score exceeds, by the letters alone."""
        each, letters = [], {}
        for t, f, k in zip(self.side.each, self.own, self.side.alike, strict=True):
            letters[len(letters)] = sorted(f)
            if k == len(letters) - 1 or letters[k] != letters[len(letters) - 1]:
                each.append(t.quick_bounds(f))
        return reduce(np.maximum, each)

    def bounds(self, which: np.ndarray | None = None) -> np.ndarray:
        """What no score exceeds, by common subsequences, of all texts or of ``which``."""
        return reduce(np.maximum, [t.bounds(f, which) for t, f in zip(self.side.each, self.own, strict=True)])

    @cached_property
    def bound(self) -> np.ndarray:
        return self.bounds() if self.side.forms else np.zeros(0)

    def score(self, k: int) -> float:
        other = self.side.forms[k]
        if other not in self.known:
            self.known[other] = self.side.score(self.own, other)
        return self.known[other]

    def possible(self, floor: float) -> np.ndarray:
        """All texts that no bound keeps under ``floor``."""
        may = np.flatnonzero(self.quick >= floor)
        return may[self.bounds(may) >= floor] if len(may) else may

    def reaching(self, floor: float) -> list[tuple[int, float]]:
        """All texts that score ``floor`` or more."""
        found = [(k, self.score(k)) for k in self.possible(floor).tolist()]
        return [(k, s) for k, s in found if s >= floor]

    def best(self, count: int, tie: Callable[[int], tuple], among: np.ndarray | None = None, least: float = 0.0) -> list[int]:
        """The ``count`` best by score, then by the largest ``tie``, of all or of ``among``; what scores under ``least`` may be left out.

        Goes down by the letters in steps, and inside a step by the common subsequences, and ends where nothing that is
        left can reach the last of the best.
        """
        quick = self.quick if among is None else self.quick[among]
        held: list[tuple] = []
        floor, before = float(quick.max(initial=0.0)), np.inf
        if floor < least:
            return []
        while len(quick) and before > least and not (len(held) == count and held[-1][0] >= before):
            fresh = np.flatnonzero((quick >= floor) & (quick < before))
            fresh = fresh if among is None else among[fresh]
            bound = self.bounds(fresh)
            for at in np.argsort(-bound, kind="stable").tolist():
                if bound[at] < least or len(held) == count and bound[at] < held[-1][0]:
                    break
                k = int(fresh[at])
                held = sorted([*held, (self.score(k), tie(k), k)], reverse=True)[:count]
            if floor <= 0.0:
                break
            floor, before = max(floor - STEP, held[-1][0] if len(held) == count else 0.0, 0.0), floor
        return [k for _, _, k in held]


def in_blocks(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, rows: int | None = None, left_rows: int = SIDE_ROWS) -> DataFrame:
    """``work`` on every pair of blocks of the rows of ``left`` and ``right`` that agree in ``keys``.

    Groups of up to ``rows`` rows (``left_rows`` and ``OTHER_ROWS``) are one block, larger ones are dealt into several by a hash of
    their id. Every pair of rows with equal keys meets exactly once. Keys without rows on both sides do not come up.
    """
    sides = (rows or left_rows, rows or OTHER_ROWS)
    sizes = left.groupBy(*keys).agg(F.count("*").alias("__l")).join(right.groupBy(*keys).agg(F.count("*").alias("__r")), keys) if keys else None
    if sizes is None:
        sizes = left.agg(F.count("*").alias("__l")).crossJoin(right.agg(F.count("*").alias("__r")))
    sizes = sizes.select(*keys, F.ceil(F.col("__l") / sides[0]).cast("int").alias("__nl"), F.ceil(F.col("__r") / sides[1]).cast("int").alias("__nr")).where("__nl > 0 AND __nr > 0")

    def dealt(df: DataFrame, own: str, other: str, n: str, across: str, row_id: str) -> DataFrame:
        got = df.join(sizes, keys) if keys else df.crossJoin(F.broadcast(sizes))
        got = got.withColumn(own, F.pmod(F.xxhash64(row_id), F.col(n).cast("long")).cast("int"))
        return got.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(across) - 1))).drop("__nl", "__nr")

    places = [*keys, "__lb", "__rb"]
    one = dealt(left, "__lb", "__rb", "__nl", "__nr", left_id).groupBy(*places)
    # columns of their own, since both sides may come from one table
    two = dealt(right, "__rb", "__lb", "__nr", "__nl", right_id)
    two = two.select(*[F.col(c).alias(c) for c in two.columns]).groupBy(*places)
    return one.cogroup(two).applyInPandas(lambda a, b: work(a, b) if len(a) and len(b) else _none(schema), schema)


def by_text(part: pd.DataFrame, text: str, *columns: str) -> Iterable[tuple[str, list[tuple]]]:
    """Every text with the values of ``columns`` of its rows."""
    found: dict[str, list[tuple]] = {}
    for t, *row in zip(part[text].tolist(), *[part[c].tolist() for c in columns], strict=True):
        found.setdefault(t, []).append(tuple(row))
    return found.items()


def _none(schema: str) -> pd.DataFrame:
    return pd.DataFrame(columns=[c.split()[0].strip("`") for c in schema.split(", ")])


def similar_pairs(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, left_text: str, right_id: str, right_text: str, floor: float, kind: str = "ratio", rows: int | None = None) -> DataFrame:
    """(keys, left id, right id, score) of the pairs under equal ``keys`` that score ``floor`` or more; ids are numbers and named apart."""

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        side, ids, own, out = Side(b[right_text].tolist(), kind), b[right_id].tolist(), tuple(a[keys].iloc[0]), []
        for text, group in by_text(a, left_text, left_id):
            found = side.against(text).reaching(floor)
            out += [(*own, row, ids[k], s) for (row,) in group for k, s in found]
        return pd.DataFrame(out, columns=[*keys, left_id, right_id, "score"])

    one, two = left.select(*keys, left_id, left_text), right.select(*keys, right_id, right_text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in one.select(*keys).schema] if keys else []
    return in_blocks(one, two, keys, left_id, right_id, work, ", ".join([*fields, f"{left_id} long", f"{right_id} long", "score double"]), rows)


def possible_pairs(texts: DataFrame, keys: list[str], text: str, floor: float, kind: str, rows: int | None = None) -> DataFrame:
    """(keys, a, b) of different texts under equal ``keys``, each pair once, whose score can reach ``floor`` whichever way they are compared."""
    one = texts.select(*keys, F.col(text).alias("a"))
    two = texts.select(*keys, F.col(text).alias("b"))

    def work(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        names, own, out = y["b"].tolist(), tuple(x[keys].iloc[0]), []
        side = Side(names, kind)
        for a in x["a"]:
            out += [(*own, a, names[k]) for k in side.against(a).possible(floor).tolist() if a < names[k]]
        return pd.DataFrame(out, columns=[*keys, "a", "b"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in one.schema] + ["b string"]
    return in_blocks(one, two, keys, "a", "b", work, ", ".join(fields), rows)


def best_rows(left: DataFrame, right: DataFrame, keys: list[str], kind: str = "ratio", turned: bool = False, rows: int | None = None) -> DataFrame:
    """(keys, row, other, score, second) of every row of ``left`` (keys, row, text): its best row of ``right``, the first of equals, and the next best score, 0 without one.

    With ``turned`` texts of ``right`` come first in the comparison.
    """

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        numbers, own, out = b["row"].tolist(), tuple(a[keys].iloc[0]), []
        side = Side(b["text"].tolist(), kind, turned)
        for text, group in by_text(a, "text", "row"):
            held = side.against(text)
            top = held.best(2, lambda k: (-numbers[k],))
            out += [(*own, row, numbers[k], held.score(k)) for (row,) in group for k in top]
        return pd.DataFrame(out, columns=[*keys, "row", "other", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in left.select(*keys).schema] + ["row long", "other long", "score double"]
    found = in_blocks(left, right, keys, "row", "row", work, ", ".join(fields), rows)
    top = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", (-F.col("other")).alias("back"))))), 1, 2)
    got = found.groupBy(*keys, "row").agg(top.alias("top"))
    return got.select(*keys, "row", (-F.col("top")[0]["back"]).alias("other"), F.col("top")[0]["score"].alias("score"), F.coalesce(F.get("top", F.lit(1))["score"], F.lit(0.0)).alias("second"))


def best_two(left: DataFrame, right: DataFrame, keys: list[str], left_text: str, right_text: str, kind: str = "ratio", rows: int | None = None) -> DataFrame:
    """(keys, left text, right text, score) of the two best right texts per distinct left text, per pair of blocks; of equal scores the larger text."""
    one, two = left.select(*keys, left_text).distinct(), right.select(*keys, right_text).distinct()
    n = len(keys)

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = b[right_text].tolist()
        side, out = Side(names, kind), []
        for row in a[[*keys, left_text]].itertuples(index=False):
            held = side.against(row[n])
            out += [(*row, names[k], held.score(k)) for k in held.best(2, lambda k: (names[k],))]
        return pd.DataFrame(out, columns=[*keys, left_text, right_text, "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in one.schema] + [f"`{right_text}` string", "score double"]
    return in_blocks(one, two, keys, left_text, right_text, work, ", ".join(fields), rows)


class Tellers:
    """Parts of the names of one side by place, to find those that could be a short form of another name or it of them."""

    def __init__(self, names: Sequence[str], least: float):
        parts = [n.split() for n in names]
        self.least, self.count = least, np.array([len(p) for p in parts], np.int64)
        self.letter = np.array([1 in map(len, p) for p in parts], bool)
        width = int(self.count.max(initial=0))
        self.places = [Texts([p[k] if k < len(p) else "" for p in parts]) for k in range(width)]
        self.first = [np.array([ord(p[k][0]) if k < len(p) else 0 for p in parts], np.uint32) for k in range(width)]
        self.single = np.flatnonzero(self.places[0].size <= 1) if width else np.zeros(0, np.int64)
        self.lows: dict[int, np.ndarray] = {}

    def opening(self, part: str, parts: int) -> np.ndarray:
        """Which names can still be evidence once the first of ``parts`` parts is held against theirs, by its letters."""
        if len(part) == 1:
            return self.first[0] == ord(part)
        if parts not in self.lows:
            self.lows[parts] = (100.0 - 1e-3 - (100.0 - self.least) * np.minimum(self.count, parts)).astype(np.float32)
        may = self.places[0].quick_bounds(part) >= self.lows[parts]
        may[self.single] = self.first[0][self.single] == ord(part[0])
        return may

    def of(self, name: str) -> np.ndarray:
        """Which names may be evidence with ``name``: no clash, and whole parts that can be alike on the average."""
        own = name.split()
        if not own or not len(self.count):
            return np.zeros(0, np.int64)
        if not self.places:
            return np.zeros(0, np.int64)
        may = self.opening(own[0], len(own)) & (self.count > 0)
        if 1 not in map(len, own):
            may &= (self.count != len(own)) | self.letter
        alive = np.flatnonzero(may)
        total, whole, gone = np.zeros(len(self.count)), np.zeros(len(self.count), np.int64), np.zeros(len(self.count), bool)
        for k, part in enumerate(own[: len(self.places)]):
            there = alive[self.count[alive] > k]
            size = self.places[k].size[there]
            single = np.minimum(size, len(part)) == 1
            clash = single & (self.first[k][there] != ord(part[0]))
            full = there[~single]
            gone[there[clash]] = True
            # what is still to come can be alike at best; the letters alone rule most out
            rest = np.minimum(self.count[full], len(own)) - k - 1
            short = lambda bound: total[full] + bound + 100.0 * rest < (self.least - 1e-9) * (whole[full] + 1 + rest)  # noqa: B023, E731
            low = short(self.places[k].quick_bounds(part, full))
            gone[full[low]] = True
            full, rest = full[~low], rest[~low]
            bound = self.places[k].bounds(part, full)
            gone[full[short(bound)]] = True
            total[full] += bound
            whole[full] += 1
            alive = alive[~gone[alive]]
        n = whole[alive]
        return alive[(n == 0) | (total[alive] >= (self.least - 1e-9) * n)]


PAIRS = "src_row long, r_row long, score double, tells boolean, r_section string, r_student string"


def candidate_pairs(source: DataFrame, roster: DataFrame, keys: list[str], floor: float, nearest_below: float | None = None, telling: float | None = None, kind: str = "ratio", rows: int | None = None) -> DataFrame:
    """(src_row, r_row, score, tells, r_section, r_student) of the pairs under ``keys`` that matter.

    These are the pairs that score ``floor`` or more; with ``nearest_below``, for source rows nothing scores over that
    the best pair at all and the best in the own section, by score, own section, first roster row; and with ``telling``
    the pairs whose whole parts can be so similar that one name may be a short form of the other.
    """

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names, sections, numbers = (b[c].tolist() for c in ("r_student", "r_section", "r_row"))
        side, parts, out = Side(names, kind), Tellers(names, telling) if telling is not None else None, []
        of_section: dict[str, np.ndarray] = {s: np.flatnonzero(b["r_section"].to_numpy() == s) for s in set(sections)}
        for text, mine_rows in by_text(a, "student", "src_row", "section"):
            held = side.against(text)
            found = dict(held.reaching(floor))
            tells = set(parts.of(text).tolist()) if parts else set()
            wanted = {k: held.score(k) for k in tells} | found
            near = nearest_below is not None and not any(s > nearest_below for s in found.values())
            for row, section in mine_rows:
                mine = dict(wanted)
                if near:
                    tie = lambda k: (section != "" and sections[k] == section, -numbers[k], sections[k], names[k])  # noqa: B023, E731
                    own = held.best(1, tie, of_section.get(section)) if section and section in of_section else []
                    mine |= {k: held.score(k) for k in [*held.best(1, tie), *own]}
                out += [(row, numbers[k], s, k in tells, sections[k], names[k]) for k, s in mine.items()]
        return pd.DataFrame(out, columns=[c.split()[0] for c in PAIRS.split(", ")])

    fill = lambda *names: [F.coalesce(n, F.lit("")).alias(n) for n in names]
    one = source.select(*keys, "src_row", *fill("student", "section"))
    two = roster.select(*keys, "r_row", *fill("r_student", "r_section"))
    return in_blocks(one, two, keys, "src_row", "r_row", work, PAIRS, rows)
