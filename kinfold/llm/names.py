"""Variant spellings of names: a prefix-filtered set-similarity join on token q-grams, verified by soft weighted token similarity."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.lookalike import normalize_text
from kinfold.operators.graph import connected_components
from kinfold.operators.skew import lookup_join
from kinfold.scratch import Scratch

# English and some other short forms of given names, by the full name; fixed values.
SHORT_FORMS = {
    "abigail": "abby nabby", "alexander": "alex sandy alec alexr", "aleksandra": "sasha", "anthony": "tony", "benjamin": "ben benj", "charles": "charlie chas chuck", "daniel": "dan danl",
    "dorothy": "dot dolly dolley", "edward": "ned ted edw eddie", "elizabeth": "bess betty liz beth eliza lizzie eliz", "frances": "fanny", "francisco": "paco pancho", "frederick": "fred fredk",
    "george": "geo", "giuseppe": "beppe peppe", "guillermo": "memo", "henry": "hal harry hank", "isabella": "bella", "jacob": "jake", "james": "jas jim jimmy", "johannes": "hans joh",
    "john": "jno jack johnny", "joseph": "joe jos", "jose": "pepe", "katherine": "kate kathy kitty", "lawrence": "larry", "margaret": "maggie peggy meg", "martha": "patty", "mary": "molly polly",
    "matilda": "tilly tilda", "nathaniel": "nat nathl", "rachel": "rae", "richard": "dick rich rick richd", "robert": "bob rob robt bobby", "samuel": "sam saml", "susannah": "sue susan sukey", "theodore": "theo ted",
    "thomas": "thos tom", "timothy": "tim", "william": "bill billy will willy wm", "zacharias": "zach",
}
FULL_FORMS = {short: frozenset(full for full, forms in SHORT_FORMS.items() if short in forms.split()) for forms in SHORT_FORMS.values() for short in forms.split()}
# Titles and function words beside a name, which weigh nothing; fixed values.
STOP = frozenset("sir dr rev prof mr mrs ms miss lady lord dame saint st capt col gen hon jr sr messrs fr br esq ltd inc the of and for de la le company co".split())
# Initials of titles, which may stand before other initials; fixed values.
TITLE_INITIALS = frozenset("rpds")
_LETTERS = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "đ": "d", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i"})
_RANGE = re.compile(r"(?<!\d)(\d{3,4})\s*[-‐‑‒–—―]\s*(\d{3,4})?(?!\d)|[-‐‑‒–—―]\s*(\d{3,4})(?!\d)")
_BORN, _DIED, _YEAR = re.compile(r"\b(?:born|b|geb)\b\.?\s*(\d{3,4})(?!\d)"), re.compile(r"\b(?:died|d|gest)\b\.?\s*(\d{3,4})(?!\d)"), re.compile(r"(?<!\d)(\d{4})(?!\d)")
_DATED = re.compile(r"\b(?:born|b|geb|died|d|gest|fl|ca)\b\.?(?=\s*\d)")
_FIRM = re.compile(r"&|\b(?:and|und|et)\b")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")

#: A spelling may be a misspelling of a more frequent one if it occurs in at most so many names, or by so many times fewer.
RARE, TIMES = 3, 5
_Q = 3
#: One edit or swap of neighbours changes at most q + 1 of a token's q-grams, so of two similar tokens' q + 3 rarest two are common to both.
_PREFIX = _Q + 3
#: A word is no part of a name if so much of the names with it, and so many, occur without it as well.
DROPPED, SUPPORT = 0.5, 5
#: Words are taken into a name's prefix, the rarest first, until the rest weigh less than this share: for names compared with
#: the year of birth as further evidence, and for the others.
SHARE_DATED, SHARE_UNDATED = 0.4, 0.6
#: Added to a word's frequency in its weight, so that single occurrences (errors, most of them) do not outweigh all else.
SMOOTHING = 5
#: Most weight of a match between an initial and a word.
INITIAL = 2.5
#: So many words that both names have are tried as the one that may stand anywhere: the heaviest, and others if nothing is left over then.
ANCHORS = 3
#: Least similarity of names of the same entity; from AGAINST on a name below it speaks against being one (most of its weight is common).
LEAST_SIMILARITY, AGAINST = 0.82, 0.5


def folded(s: str) -> str:
    s = s.lower().translate(_LETTERS)
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def one_edit(a: str, b: str) -> bool:
    """One letter inserted, left out, replaced, or two neighbours swapped."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :] or (a[k : k + 2] == b[k : k + 2][::-1] and a[k + 2 :] == b[k + 2 :])
    return a[k:] == b[k + 1 :]


def two_edits(a: str, b: str) -> bool:
    """At most two letters inserted, left out, replaced or swapped: one edit of what follows the common start, and another one."""
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    x, y = a[k:], b[k:]
    return one_edit(x[1:], y[1:]) or one_edit(x[1:], y) or one_edit(x, y[1:]) or (x[:2] == y[:2][::-1] and one_edit(x[2:], y[2:]))


def parse(name: str) -> tuple[list[str], int | None, int | None]:
    """(words, what stands before a comma last; year of birth, year of death). Titles and function words are left out unless there is no other."""
    low = folded(name)
    birth = death = None
    words = low
    if m := _RANGE.search(low):  # a letter before a range of years is an initial
        birth, death = (int(x) if x else None for x in (m[1], m[2] or m[3]))
    else:
        birth = int(m[1]) if (m := _BORN.search(low)) else None
        death = int(m[1]) if (m := _DIED.search(low)) else None
        if birth is None and death is None and (m := _YEAR.search(low)):
            birth = int(m[1])
        words = _DATED.sub(" ", low)
    left, _, right = words.partition(",")
    every = [_WORD.findall(left), _WORD.findall(right)]
    # "Heath & Sons, Printers" is no inversion
    every = sum(every if _FIRM.search(left) else every[::-1], [])
    return [w for w in every if w not in STOP] or every, birth, death


_PARSED = "id string, spelling string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of a parsed name in one text, by which equal names are found."""
    for b in batches:
        ids, texts = [], []
        for i, form in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words, birth, death = parse(form)
            if words:
                ids.append(i)
                texts.append(f"{' '.join(words)}\t{birth or ''}\t{death or ''}")
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=["id", "spelling"])


def droppable(names: DataFrame, share: float, support: int) -> DataFrame:
    """(token): words that names do without, found from the data: at least `share` of the names with the word, `support` of them or more,
    occur without it too, with the same other words and years. Titles and the like are such words, names are not.
    """
    mark = lambda words: F.xxhash64(F.array_sort(words), F.coalesce("birth", F.lit(0)), F.coalesce("death", F.lit(0)))
    whole = names.select(mark("words").alias("rest"), F.lit(True).alias("there")).distinct()
    less = lambda i: F.concat(F.slice("words", F.lit(1), i - 1), F.slice("words", i + 1, F.size("words")))
    parts = names.where(F.size("words") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.struct(F.element_at("words", i).alias("token"), mark(less(i)).alias("rest")))).alias("x")).select("x.*")
    counts = parts.join(whole, "rest", "left").groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count("there").alias("without"))
    return counts.where((F.col("n") >= support) & (F.col("without") >= share * F.col("n"))).select("token")


def token_variants(tokens: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, other): spellings one edit apart, from the rarer to the more frequent; of (token, n).

    A set-similarity join on q-grams with a prefix filter: q-grams are ordered by frequency, the rarest first, and only
    tokens that share two of their rarest q-grams are compared (one, of the tokens of three letters). Two q-grams together are
    rare where one alone is common, so common beginnings and endings bring no more tokens together than the whole tokens have.
    """
    long = tokens.where("length(token) >= 3")
    grams = long.select("token", "n", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("token") + (_Q - 1)), lambda i: F.substring(F.concat(F.lit("#" * (_Q - 1)), F.col("token"), F.lit("$" * (_Q - 1))), i, F.lit(_Q))))).alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    prefix = grams.join(frequency, "gram").groupBy("token", "n").agg(F.slice(F.array_sort(F.collect_list(F.struct("df", "gram"))), 1, _PREFIX).alias("p")).select("token", "n", F.col("p.gram").alias("p"))
    couples = F.flatten(F.transform("p", lambda x, i: F.transform(F.slice("p", i + 2, F.lit(_PREFIX)), lambda y: F.xxhash64(F.least(x, y), F.greatest(x, y)))))
    single = F.when(F.length("token") == 3, F.transform("p", lambda x: F.xxhash64(x, F.lit(3)))).otherwise(F.when(F.length("token") == 4, F.concat(couples, F.transform("p", lambda x: F.xxhash64(x, F.lit(3))))).otherwise(couples))
    keys = scratch.save(prefix.select("token", "n", F.explode(single).alias("k")))
    a, b = keys.alias("a"), keys.alias("b")
    rarer = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.token") > F.col("b.token")))
    rare = (F.col("a.n") <= RARE) | (F.col("a.n") * TIMES <= F.col("b.n"))
    near = F.abs(F.length("a.token") - F.length("b.token")) <= 1
    pairs = a.join(b, (F.col("a.k") == F.col("b.k")) & rarer & rare & near).select(F.col("a.token").alias("token"), F.col("b.token").alias("other"), F.col("b.n").alias("n")).distinct()
    edits = F.levenshtein("token", "other", 2)
    letter = lambda c, i: F.substring(c, i, F.lit(1))
    at = F.filter(F.sequence(F.lit(1), F.length("token")), lambda i: letter("token", i) != letter("other", i))
    one, two = F.get(at, F.lit(0)), F.get(at, F.lit(1))
    swap = (F.length("token") == F.length("other")) & (F.size(at) == 2) & (two - one == 1) & (letter("token", one) == letter("other", two)) & (letter("token", two) == letter("other", one))
    return pairs.where(((edits >= 0) & (edits <= 1)) | ((edits == 2) & swap))


_SHAPE = "name bigint, kind int, birth int, death int, tokens array<string>, own array<string>, weights array<float>, asks array<string>, keys array<string>, asks_dated array<string>, keys_dated array<string>, sig string"
DATED, FULL, BRIEF = 0, 1, 2


def _initials(token: str, classes: list[str]) -> set[str]:
    """First letters under which a word is met: of its spellings and full forms."""
    return {x[:1] for t in [token, *classes] for x in (t, *FULL_FORMS.get(t, ()))}


def _shaped(total: int):
    def prefix(words: list[tuple[float, str, list[str]]], share: float) -> list[tuple[float, str, list[str]]]:
        left = whole = sum(w for w, _, _ in words)
        out = []
        for x in words:
            if out and left < share * whole:
                break
            out.append(x)
            left -= x[0]
        return out

    def one(birth: int | None, infos: list[dict], years: int) -> tuple:
        infos = sorted(infos, key=lambda x: x["pos"])
        tokens = [x["token"] for x in infos]
        classes = [[x["token"], *sorted(x["others"])] for x in infos]
        own = [" ".join(c) for c in classes]
        weights = [log(1 + total / (x["top"] + SMOOTHING)) for x in infos]
        kind = DATED if birth else BRIEF if len(tokens) > 1 and any(len(t) == 1 for t in tokens) else FULL
        words = sorted(((w, t, c) for w, t, c in zip(weights, tokens, classes, strict=True) if len(t) > 1), key=lambda x: (-x[0], x[1])) or list(zip(weights, tokens, classes, strict=True))

        def keys(anchors: list, mark: str, every: bool) -> set[str]:
            out = set()
            for _, anchor, spellings in anchors:
                rest = [(t, c) for t, c in zip(tokens, classes, strict=True) if t != anchor]
                first = rest if every else rest[: 2 if _titled([t for t, _ in rest]) and (mark or not birth) else 1]
                letters = {i for t, c in first for i in _initials(t, c[1:])} or {""}
                out |= {f"{s}\t{i}\t{mark}" for s in spellings for i in letters}
            return out

        year = str(birth or "")
        asks, met = keys(prefix(words, SHARE_UNDATED), "", False), keys(words, "", True)
        asks_dated, met_dated = (keys(prefix(words, SHARE_DATED), year, False), keys(words, year, True)) if birth else ((), ())
        sig = " ".join(sorted(min(FULL_FORMS.get(x["best"], {x["best"]})) for x in infos))
        return kind, tokens, own, [*weights, log(1 + total / (years + SMOOTHING))], sorted(asks), sorted(met), sorted(asks_dated), sorted(met_dated), sig

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.list_(pa.string())
        for b in batches:
            rows = [one(*x) for x in zip(b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)]
            if rows:
                kind, tokens, own, weights, *keys, sig = zip(*rows, strict=True)
                columns = [b.column(0), pa.array(kind, pa.int32()), b.column(1), b.column(2), pa.array(tokens, words), pa.array(own, words), pa.array(weights, pa.list_(pa.float32())), *[pa.array(k, words) for k in keys], pa.array(sig, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SHAPE.split(", ")])

    return run


@lru_cache(maxsize=200_000)
def token_similarity(a: str, b: str, same: bool) -> float:
    """How far two different words may be the same one; `same`: their usual spelling is the same."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 1:
        return 0.9 if a in _initials(b, []) else 0.0
    if FULL_FORMS.get(a, {a}) & FULL_FORMS.get(b, {b}):
        return 0.95
    if b.startswith(a):
        return 0.9
    if same:
        return 0.85 if one_edit(a, b) else 0.8
    if len(a) > 5 and two_edits(a, b):
        return 0.8 if one_edit(a, b) else 0.75
    if a[:5] == b[:5] and len(a) > 6 and abs(len(a) - len(b)) < 3:
        return 0.75
    return 0.0


def _similarity(t: str, own_t: str, o: str, own_o: str) -> float:
    if t == o:
        return 1.0
    same = (own_t != t or own_o != o) and not set(own_t.split(" ")).isdisjoint(own_o.split(" "))
    return token_similarity(t, o, same)


def _matches(a: list[str], own_a: list[str], b: list[str], own_b: list[str], skip: tuple[int, int]) -> list[tuple[int, int, float]]:
    """Words that agree, apart from `skip`, from the first ones on and in their order; none if the first ones differ."""
    x, y = [i for i in range(len(a)) if i != skip[0]], [j for j in range(len(b)) if j != skip[1]]
    if x and y and not _similarity(a[x[0]], own_a[x[0]], b[y[0]], own_b[y[0]]):
        # a title shortened to an initial among initials
        if len(x) == len(y) + 1 and _titled([a[i] for i in x]):
            x = x[1:]
        elif len(y) == len(x) + 1 and _titled([b[j] for j in y]):
            y = y[1:]
    out, at = [], 0
    for i in x:
        for k in range(at, len(y)):
            if s := _similarity(a[i], own_a[i], b[y[k]], own_b[y[k]]):
                out.append((i, y[k], s))
                at = k + 1
                break
        if not at:  # the first word has no match
            return []
    return out if not out or out[0][1] == y[0] else []


def _titled(rest: list[str]) -> bool:
    """Initials of which the first may be a title's."""
    return len(rest) > 1 and rest[0] in TITLE_INITIALS and all(len(t) == 1 for t in rest)


def compared(a: list[str], own_a: list[str], wa: list[float], b: list[str], own_b: list[str], wb: list[float], date: float = 0.0) -> tuple[float, bool, bool, bool, bool, bool]:
    """(similarity, words of a are left, of b are left, a has a word for an initial, b has one, spellings differ); `own` are the spellings a word may stand for.

    One of the heaviest words that both have, softly, may stand anywhere; the others are matched in their order. The similarity is the
    weight of the matches, softly, in that of all matches and of the words left in the name that has fewer of them: what one name
    alone says more does not count against the other, what both say differently does. `date` is the weight of a date that both have.
    """
    weight = lambda i, j: min(wa[i], wb[j], INITIAL) if min(len(a[i]), len(b[j])) == 1 and a[i] != b[j] else min(wa[i], wb[j])
    anchors = [(s * weight(i, j), i, j, s) for i, t in enumerate(a) for j, o in enumerate(b) if (s := _similarity(t, own_a[i], o, own_b[j]))]
    best = (0.0, True, True, False, False, True)
    for n, (_, *anchor) in enumerate(sorted(anchors, key=lambda x: -x[0])[:ANCHORS]):
        matches = [anchor, *_matches(a, own_a, b, own_b, anchor[:2])]
        got = total = date
        for i, j, s in matches:
            total, got = total + weight(i, j), got + weight(i, j) * s
        ia, ib = {i for i, _, _ in matches}, {j for _, j, _ in matches}
        left, other = (sum(w for k, w in zip(range(len(t)), ws, strict=False) if k not in seen) for t, ws, seen in ((a, wa, ia), (b, wb, ib)))
        x = got / (total + min(left, other))
        if left and other:  # many common words do not make up for a contradiction
            x = min(x, (date + anchor[2] * weight(*anchor[:2])) / (date + weight(*anchor[:2]) + min(left, other)))
        if not n or (x > best[0] and not (left or other)):
            more_a, more_b = any(len(a[i]) > 1 == len(b[j]) for i, j, _ in matches), any(len(b[j]) > 1 == len(a[i]) for i, j, _ in matches)
            best = x, left > 0, other > 0, more_a, more_b, any(s < 0.9 for _, _, s in matches)
        if not (left and other):
            break
    return best


def soft_similarity(a: list[str], wa: list[float], b: list[str], wb: list[float]) -> float:
    """The soft weighted similarity of two lists of words with their weights: rare words count for more."""
    return compared(a, a, wa, b, b, wb)[0]


_VERIFIED = "a bigint, b bigint, score float, left_a boolean, left_b boolean, more_a boolean, more_b boolean, differ boolean"


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in batches:
            c = [r.column(k).to_pylist() for k in range(r.num_columns)]
            keep, out = [], []
            for k, (a, own_a, wa, b, own_b, wb, both, dated_b) in enumerate(zip(*c[2:], strict=True)):
                x = compared(a, own_a, wa, b, own_b, wb, min(wa[-1], wb[-1]) if both else 0.0)
                if x[0] >= least or (dated_b and x[0] >= AGAINST):
                    keep.append(k)
                    out.append(x)
            score, *flags = zip(*out, strict=True) if out else [()] * 6
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([r.column(0).take(at), r.column(1).take(at), pa.array(score, pa.float32()), *[pa.array(f, pa.bool_()) for f in flags]], names=[f.split()[0] for f in _VERIFIED.split(", ")])

    return run


def similar_names(shaped: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(a, b, ...) once for each pair of similar names: dated ones of one year of birth, undated ones with each other and with dated ones.

    Words of a name's prefix ask for all words of other names, so what one name has more of does not keep it from being met; only
    numbers of names meet. Of an undated name (a) and dated ones (b) less similar pairs come out too, which speak against an entity.
    """
    keys = lambda c, dated: shaped.select(F.explode(F.transform(c, lambda k: F.xxhash64(k))).alias("k"), "name", (F.col("kind") == DATED).alias("dated"), F.lit(dated).alias("years"))
    a, b = (keys(c, False).unionByName(keys(f"{c}_dated", True)).alias(s) for c, s in (("asks", "a"), ("keys", "b")))
    one, other = F.struct("a.dated", "a.name"), F.struct("b.dated", "b.name")  # an undated name comes before a dated one
    pairs = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.years") == F.col("b.years")) & (F.col("a.name") != F.col("b.name")) & (F.col("a.years") | ~F.col("a.dated") | ~F.col("b.dated")))
    met = scratch.save(pairs.select(F.least(one, other).alias("a"), F.greatest(one, other).alias("b")).distinct().select(F.col("a.name").alias("a"), F.col("b.name").alias("b")))
    info = scratch.save(shaped.select("name", F.struct("kind", "birth", "death", "tokens", "own", "weights").alias("i")))
    side = lambda s: info.select(F.col("name").alias(s), F.col("i").alias(f"i{s}"))
    both = met.join(side("a"), "a").join(side("b"), "b")
    agree = F.coalesce(F.col("ia.death") == F.col("ib.death"), F.lit(True)) & F.coalesce(F.col("ia.birth") == F.col("ib.birth"), F.lit(True))
    same_year = F.coalesce(F.col("ia.birth") == F.col("ib.birth"), F.lit(False))
    columns = [F.col(f"i{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("tokens", "own", "weights")]
    alike = scratch.save(both.where(agree).select("a", "b", *columns, same_year.alias("both"), ((F.col("ia.kind") != DATED) & (F.col("ib.kind") == DATED)).alias("dated_b")).mapInArrow(_verify(least), _VERIFIED))
    scratch.drop(met, info)
    return alike


def name_entities(values: DataFrame, key: str, value: str, least_similarity: float = LEAST_SIMILARITY) -> DataFrame:
    """(key, entity): keys whose names denote the same person or organisation have the same entity, the smallest of the keys.

    Differences in case, accents, punctuation, look-alike characters, order of the parts, titles, abbreviations, short
    forms, initials, left-out second names or dates, and single typing errors do not matter; names with different years
    of birth are different persons. A name without dates joins a dated one only if all dated names that it fits best have one
    year of birth, so that it never bridges namesakes; an ambiguous one stays with those spelt like it. Null values and
    values without a letter are left out; repeated rows count once; other columns are ignored.

    A name is a set of words, each weighted by its rarity and standing for all q-grams of its spelling. Words meet through a
    q-gram join of the distinct words (`token_variants`), names through the spellings of their rarest words (`SHARE_DATED`, `SHARE_UNDATED`)
    together with a first letter of another word and, for dated names, the year of birth. Words that names mostly do without weigh
    nothing (`droppable`). All pairs that meet are verified by
    their soft weighted similarity. All this happens among distinct parsed names, so a name on a third of all rows is one row.
    """
    scratch = Scratch(values.sparkSession, "names")
    single = values.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.min(value).alias("value"))
    parsed = scratch.save(normalize_text(single, "value", "form").select("id", "form").mapInArrow(_parse, _PARSED))
    # each distinct name is a number from here on
    numbered, total = scratch.save_counted(parsed.select("spelling").distinct().withColumn("name", F.monotonically_increasing_id()))
    members = scratch.save(parsed.join(numbered, "spelling").select("id", "name"))
    scratch.drop(parsed)
    part = F.split("spelling", "\t")
    year = lambda k: F.nullif(part[k], F.lit("")).cast("int")
    names = numbered.select("name", F.split(part[0], " ").alias("words"), year(1).alias("birth"), year(2).alias("death"))

    placed = names.select("name", F.posexplode("words").alias("pos", "token"))
    stats = scratch.save(placed.groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    near = token_variants(stats, scratch).groupBy("token").agg(F.collect_list("other").alias("others"), F.max(F.struct("n", F.col("other").alias("best"))).alias("m"))
    # a short form is as frequent as its full form, a beginning as the most frequent word that it may shorten
    starts = stats.where("length(token) > 3").select("n", F.col("token").alias("whole"), F.explode(F.transform(F.sequence(F.lit(3), F.length("token") - 1), lambda n: F.substring("token", F.lit(1), n))).alias("token"))
    starts = starts.join(stats.select("token"), "token").groupBy("token").agg(F.max(F.struct("n", "whole")).alias("w"))
    forms = values.sparkSession.createDataFrame([(s, f) for s, fulls in FULL_FORMS.items() for f in fulls], "short string, token string").join(stats, "token").groupBy(F.col("short").alias("token")).agg(F.max("n").alias("full_n"))
    infos = stats.join(near, "token", "left").join(starts, "token", "left").join(F.broadcast(forms), "token", "left")
    others = F.array_compact(F.array_append(F.coalesce("others", F.array().cast("array<string>")), F.when(F.col("w.n") >= F.col("n"), F.col("w.whole"))))
    infos = infos.join(droppable(names, DROPPED, SUPPORT), "token", "left_anti")
    infos = scratch.save(infos.select("token", "n", others.alias("others"), F.greatest("n", "m.n", "full_n", "w.n").alias("top"), F.coalesce("m.best", "token").alias("best")))
    shaped = placed.join(infos, "token").groupBy("name").agg(F.collect_list(F.struct("pos", "token", "n", "top", "best", "others")).alias("infos"))
    years = names.where("birth IS NOT NULL").groupBy("birth").agg(F.count(F.lit(1)).alias("years"))
    shaped = names.select("name", "birth", "death").join(shaped, "name").join(years, "birth", "left").select("name", "birth", "death", "infos", F.coalesce("years", F.lit(total)).alias("years"))
    shaped = scratch.save(shaped.mapInArrow(_shaped(total), _SHAPE))
    scratch.drop(stats, infos)
    alike = similar_names(shaped, least_similarity, scratch)

    links = scratch.save(_links(alike, shaped, least_similarity, scratch))
    scratch.drop(alike, shaped)
    groups = connected_components(links, "one", "two")
    entities = scratch.save(members.join(groups.select(F.col("id").alias("name"), "component"), "name", "left").select("id", F.coalesce("component", "name").alias("component")))
    return lookup_join(entities, entities.groupBy("component").agg(F.min("id").alias("entity")), ["component"], "id").select(F.col("id").alias(key), "entity")


def _links(compared: DataFrame, shaped: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(one, two): which of the similar names denote the same. Undated names take what they fit best, if that is one entity."""
    what = shaped.select("name", "kind", "birth", F.xxhash64("sig").alias("sig"))
    side = lambda s: what.select(*[F.col(c).alias(s if c == "name" else f"{c}_{s}") for c in what.columns])
    met = scratch.save(compared.join(side("a"), "a").join(side("b"), "b"))
    typed = met.where(F.col("score") >= least)
    links = typed.where(f"kind_a = {DATED} AND kind_b = {DATED}").select(F.col("a").alias("one"), F.col("b").alias("two"))
    fit = lambda u, v: typed.where(f"kind_{u} <> {DATED}").select(F.col(u).alias("u"), F.col(f"kind_{u}").alias("kind"), F.col(f"sig_{u}").alias("own"), F.col(v).alias("v"), F.col(f"kind_{v}").alias("kind_v"), F.col(f"birth_{v}").alias("birth"), F.col(f"sig_{v}").alias("sig"), (F.col(f"left_{u}") | F.col(f"more_{u}")).alias("more_u"), F.col(f"left_{v}").alias("more_v"), "differ")
    fits = fit("a", "b").unionByName(fit("b", "a"))
    # 0: the same words, 2: the other name has more of them, 4: this name has more; an error in spelling adds one
    fits = scratch.save(fits.withColumn("rank", F.when(F.col("more_u"), 4).when(F.col("more_v"), 2).otherwise(0) + F.col("differ").cast("int")))
    same = "rank < 2"

    # full names without dates that fit dated ones best of one year of birth
    first = scratch.save(_decided(fits.where(f"kind = {FULL} AND kind_v = {DATED}"), "birth"))
    # unless the fit is no full one and another name of that year says something else
    against = met.where(F.col("score") < least).select(F.col("a").alias("u"), F.col("birth_b").alias("low")).distinct()
    doubted = first.where("rank > 3").join(against, ["u", "low"], "left_semi").select("u")
    joined = scratch.save(first.where("low = high").join(doubted, "u", "left_anti"))
    links = links.unionByName(_chosen(fits.where(f"kind_v = {DATED}"), joined))
    # those that fit none, or several: with those spelt alike, and with longer ones if these are one
    open_ = shaped.where(f"kind = {FULL}").select(F.col("name").alias("u")).join(joined.select("u"), "u", "left_anti")
    rest = scratch.save(fits.where(f"kind = {FULL}").join(open_, "u", "left_semi"))
    alike_full = rest.where(f"kind_v = {FULL} AND {same}").join(open_.withColumnRenamed("u", "v"), "v", "left_semi")
    links = links.unionByName(alike_full.select("u", "v").toDF("one", "two"))
    # what stands for an entity from here on: the year of birth of those who have one, else the smallest spelling of those spelt alike
    spelt = alike_full.groupBy("u").agg(F.min("sig").alias("least"))
    stands = shaped.select(F.col("name").alias("v"), F.col("birth").cast("bigint").alias("born"), F.xxhash64("sig").alias("sig"))
    stands = stands.join(joined.select(F.col("u").alias("v"), F.col("low").cast("bigint").alias("found")), "v", "left").join(spelt.select(F.col("u").alias("v"), "least"), "v", "left")
    stands = scratch.save(stands.select("v", F.coalesce("born", "found", F.least("sig", F.coalesce("least", "sig"))).alias("e")))
    longer = rest.where(f"rank IN (2, 3) AND kind_v <> {BRIEF}").join(stands, "v")
    second = scratch.save(_decided(longer, "e").where("low = high"))
    links = links.unionByName(_chosen(longer, second))
    stands = stands.join(second.select(F.col("u").alias("v"), F.col("low").alias("longer")), "v", "left").select("v", F.coalesce("longer", "e").alias("e"))

    # names with initials: what they fit best among all full ones, else those spelt alike
    brief = fits.where(f"kind = {BRIEF}")
    full = scratch.save(brief.where(f"kind_v <> {BRIEF}").join(stands, "v"))
    third = scratch.save(_decided(full, "e").where("low = high"))
    links = links.unionByName(_chosen(full, third))
    alone = brief.where(f"kind_v = {BRIEF} AND {same}").join(third.select("u"), "u", "left_anti")
    return links.unionByName(alone.select("u", "v").toDF("one", "two")).distinct()


def _decided(fits: DataFrame, entity: str) -> DataFrame:
    """(u, rank, low, high): the best rank of each name and the smallest and largest entity it fits there."""
    return fits.groupBy("u", "rank").agg(F.min(entity).alias("low"), F.max(entity).alias("high")).groupBy("u").agg(F.min(F.struct("rank", "low", "high")).alias("m")).select("u", "m.*")


def _chosen(fits: DataFrame, decided: DataFrame) -> DataFrame:
    """(one, two) of the fits of the best rank."""
    return fits.join(decided.select("u", "rank"), ["u", "rank"], "left_semi").select(F.col("u").alias("one"), F.col("v").alias("two"))


def name_pairs(values: DataFrame, key: str, value: str) -> DataFrame:
    """(key1, key2), key1 < key2, of the same entity. The entities are what to keep at scale; pairs of a large entity are many."""
    scratch = Scratch(values.sparkSession, "name-pairs")
    entities = scratch.save(name_entities(values, key, value))
    shared = entities.where(F.col(key) != F.col("entity")).select("entity").distinct()
    several = scratch.save(entities.join(shared, "entity", "left_semi"))
    return several.withColumnRenamed(key, "key1").join(several.withColumnRenamed(key, "key2"), "entity").where("key1 < key2").select("key1", "key2")
