"""Edit-distance helpers for typo-tolerant matching.

Candidate generation uses deletion neighbourhoods (FastSS, Bocek et al.
2007): two strings within edit distance ``d`` share a string obtained by
deleting at most ``d`` characters from each (a substitution deletes the
character on both sides, an insertion/deletion on one side, an adjacent
transposition one of the two characters on both sides).  Exploding every
term into its deletion variants turns fuzzy matching into an *equi-join* on
the variant, so no term is ever compared with the whole vocabulary; the
exact distance is then computed only for the candidate pairs.

A term may match only with ``distance < min(len(a), len(b))``, so at most
``min(k, len - 1)`` deletions are ever needed per side.

Sharing a variant is not enough to be near: among numbers of few digits very
many pairs share one that lacks ``k`` characters of each.  ``meeting_keys``
leaves those out.  If ``k`` edits delete ``k`` characters on both sides, all of
them are substitutions, at the same positions of texts of one length; so such
pairs meet by their texts with ``k`` positions masked, and by a variant only
where one side lacks fewer than ``k``.  A transposition is an edit of the term
alone: ``swapped`` gives the term with neighbours turned round, which then has
that many edits fewer to be found by.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def deletion_variants(term: str, k, most: int | None = None) -> Column:
    """All strings made from column ``term`` by deleting up to
    ``min(k, length - 1)`` characters, the term itself included.

    ``k`` is an int, or the name of an int column of values up to ``most``
    (per-row fuzziness, so one explode serves fields with different fuzziness).
    """
    if isinstance(k, int):
        most = k
    if most is None or most < 0:
        raise ValueError("the largest fuzziness must be given and not negative")
    text = F.col(term)
    deletions = F.least(F.lit(k) if isinstance(k, int) else F.col(k), F.length(text) - 1)

    def shorter(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(v)),
                           lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1)))

    level, levels, out = F.array(text), [F.array(text)], F.array(text)
    for n in range(1, most + 1):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        levels.append(level)
        out = F.when(deletions >= n, F.array_distinct(F.concat(*levels))).otherwise(out)
    return out


def _each(items: list[Column]) -> Column:
    return items[0] if len(items) == 1 else F.concat(*items)


def _masked(text: Column, k: int) -> Column:
    """The text with ``k`` of its positions masked, in every way that leaves one unmasked."""
    def further(s: Column) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: i > s["at"]),
                           lambda i: F.struct(i.alias("at"), F.overlay(s["text"], F.lit("\0"), i, F.lit(1)).alias("text")))

    level = F.array(F.struct(F.lit(0).alias("at"), text.alias("text")))
    for _ in range(k):
        level = F.flatten(F.transform(level, further))
    return F.when(F.length(text) > k, F.transform(level, lambda s: s["text"])).otherwise(F.array().cast("array<string>"))


def meeting_keys(text: Column, k: int, query_side: bool) -> Column:
    """array<struct<kind, key>>: a text of the query side and one of the other
    share a key if their Levenshtein distance is at most ``k`` and below both
    lengths; few others do."""
    def shorter(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(v)),
                           lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1)))

    def of_kind(kind: str, texts: Column) -> Column:
        return F.transform(texts, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("key")))

    levels = [F.array(text)]
    for _ in range(k):
        levels.append(F.filter(F.array_distinct(F.flatten(F.transform(levels[-1], shorter))), lambda v: v != ""))
    keys = [of_kind("masked", _masked(text, k))]
    if k > 0:
        few, most = _each(levels[:-1]), levels[-1]
        keys += [of_kind("few", few), of_kind("most", most)] if query_side else \
            [of_kind("few", _each(levels)), of_kind("most", few)]
    return _each(keys)


def swapped(text: Column, k: int) -> Column:
    """array<struct<form, swaps, at>>: the text, and the text with up to ``k``
    pairs of neighbours turned round, no character twice; ``at`` is where the
    last pair stands."""
    def further(s: Column) -> Column:
        def turned(i: Column) -> Column:
            form = F.concat(F.substr(s["form"], F.lit(1), i - 1), F.substr(s["form"], i + 1, F.lit(1)),
                            F.substr(s["form"], i, F.lit(1)), F.substr(s["form"], i + 2))
            return F.struct(form.alias("form"), (s["swaps"] + 1).alias("swaps"), i.alias("at"))

        def other(i: Column) -> Column:
            return (i > s["at"] + 1) & (i < F.length(text)) & \
                (F.substr(text, i, F.lit(1)) != F.substr(text, i + 1, F.lit(1)))

        return F.transform(F.filter(F.sequence(F.lit(1), F.length(text)), other), turned)

    levels = [F.array(F.struct(text.alias("form"), F.lit(0).alias("swaps"), F.lit(-1).alias("at")))]
    for _ in range(k):
        levels.append(F.flatten(F.transform(levels[-1], further)))
    return _each(levels)


def swapped_distance(term: Column, form: Column, swaps: Column, at: Column, other: Column, k: int) -> Column:
    """The distance of ``term`` to ``other`` by way of one of its ``swapped``
    forms, null if above ``k``; the least over the forms is the OSA distance.

    What stands between a turned pair may not be edited: so with one pair, the
    parts before and after it are compared each on its own, and only with
    several pairs and further edits (``k`` of 3 or more) the matrix is filled.
    """
    lev = F.levenshtein(form, other, k)
    before, pair, after = F.substr(form, F.lit(1), at - 1), F.substr(form, at, F.lit(2)), F.substr(form, at + 2)
    cuts = []
    for shift in range(1 - k, k):
        j = at + shift
        cuts.append(F.when((j >= 1) & (F.substr(other, j, F.lit(2)) == pair),
                           F.levenshtein(before, F.substr(other, F.lit(1), j - 1))
                           + F.levenshtein(after, F.substr(other, j + 2)) + 1))
    cut = F.least(*cuts) if len(cuts) > 1 else cuts[0] if cuts else F.lit(None).cast("int")
    found = F.when(lev < 0, None).when((swaps == 0) | (lev == 0), lev + swaps).when(swaps == 1, cut)
    if k > 2:
        found = found.otherwise(osa(term, other))
    return F.when(found <= k, found)


def osa(a: Column, b: Column) -> Column:
    """Optimal-string-alignment distance (an adjacent transposition counts
    one), row by row of the distance matrix; each row knows the two above."""
    x, y = F.split(a, ""), F.split(b, "")

    def cell(above2: Column, above: Column, i: Column, row: Column, j: Column) -> Column:
        here, there = F.get(x, i - 1), F.get(y, j - 1)
        change = F.get(above, j - 1) + F.when(here == there, 0).otherwise(1)
        swap = F.when((i > 1) & (j > 1) & (here == F.get(y, j - 2)) & (F.get(x, i - 2) == there),
                      F.get(above2, j - 2) + 1)
        return F.concat(row, F.array(F.least(F.get(row, j - 1) + 1, F.get(above, j) + 1, change, swap)))

    def next_row(rows: Column, i: Column) -> Column:
        row = F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(i),
                          lambda done, j: cell(rows["above2"], rows["above"], i, done, j))
        return F.struct(rows["above"].alias("above2"), row.alias("above"))

    first = F.sequence(F.lit(0), F.length(b))
    filled = F.aggregate(F.sequence(F.lit(1), F.length(a)), F.struct(first.alias("above2"), first.alias("above")),
                         next_row, lambda rows: F.element_at(rows["above"], -1))
    return F.when(F.length(a) == 0, F.length(b)).when(F.length(b) == 0, F.length(a)).otherwise(filled)


def _may_swap(a: Column, b: Column) -> Column:
    """Whether two neighbours in ``a`` stand the other way round in ``b``."""
    def turned(i: Column) -> Column:
        left, right = F.substr(a, i, F.lit(1)), F.substr(a, i + 1, F.lit(1))
        return (left != right) & F.contains(b, F.concat(right, left))

    return (F.length(a) > 1) & F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), turned)


def with_distance(pairs, a: str, b: str, k: int, transpositions: bool, out: str = "distance"):
    """``pairs`` plus column ``out``: distance of ``a`` and ``b``, kept only
    where it is ``<= k`` (other rows are dropped).

    Levenshtein is built in (``levenshtein(a, b, threshold)`` is -1 above the
    threshold).  With transpositions, Levenshtein 0 or 1 is already the OSA
    distance and one above ``2k`` a certain miss (a transposition saves at
    most one edit of two); in between the matrix is filled, but only if a pair
    of neighbours is turned at all.  The distance comes out of a generator, so
    no filter above makes Spark work it out a second time.
    """
    ca, cb = F.col(a), F.col(b)
    lev = F.levenshtein(ca, cb, 2 * k if transpositions else k)
    near = F.when(lev >= 0, lev)
    if transpositions:
        near = F.when(lev < 0, None).when((lev <= 1) | ~_may_swap(ca, cb), lev).otherwise(osa(ca, cb))
    found = F.filter(F.array(near.cast("bigint")), lambda d: d <= k)
    return pairs.select("*", F.explode(found).alias(out))
