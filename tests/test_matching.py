"""Name candidates against all pairs: corrections that are known, odd names, ties, empty sides, plan."""

import random
import re

from starloom.lookups import COUNTRY_CODE_NAMES, TEMPERATURE_NAMES
from starloom.operators.matching import name_candidates

OTHERS = ["Albania", "Canada", "Guinea", "Niger", "Nigeria", "Mexico", "China", "United States", "Puerto Rico", "Congo",
          "Bosnia And Herzegovina", "Guinea Bissau", "United Kingdom", "Ivory Coast", "Japan"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute(left, right, least, top):
    def plain(n):
        return re.sub(r"[\W_]+", " ", n.lower()).strip()

    def grams(p):
        return {f" {p} "[i : i + 3] for i in range(max(len(p), 1))}

    out = []
    for a in {n for n in left if n and plain(n)}:
        found = []
        for b in {n for n in right if n and plain(n)}:
            ga, gb, pa, pb = grams(plain(a)), grams(plain(b)), plain(a), plain(b)
            overlap = len(ga & gb) / min(len(ga), len(gb))
            if overlap >= least:
                found.append((-overlap, -(1 - distance(pa, pb) / max(len(pa), len(pb))), b))
        out += [(a, b, round(-o, 9), round(-e, 9), r) for r, (o, e, b) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def ours(spark, left, right, **options):
    sides = [spark.createDataFrame([(n,) for n in names], "n string") for names in (left, right)]
    return sorted((r.name, r.candidate, round(r.overlap, 9), round(r.edit, 9), r["rank"]) for r in name_candidates(sides[0], "n", sides[1], "n", **options).collect())


def test_known_corrections_are_found(spark):
    found = {(a, b): rank for a, b, _, _, rank in ours(spark, list(COUNTRY_CODE_NAMES), OTHERS)}
    for name, right in COUNTRY_CODE_NAMES.items():
        assert found[name, right.title()] == 1
    congo = next(n for n, r in TEMPERATURE_NAMES.items() if r == "Congo")
    assert ours(spark, [congo], OTHERS)[0][1] == "Congo"


def test_candidates_match_all_pairs(spark):
    rng = random.Random(5)
    names = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 4))) for _ in range(120)]
    left, right = [*names[:60], None, "", "--", "x", "Ünï", names[0]], [*names[60:], names[1], None, "!", "X", "ünï "]
    for least, top in ((0.6, 3), (0.3, 5), (1.0, 2)):
        assert ours(spark, left, right, least=least, top=top) == brute(left, right, least, top)


def test_empty_sides_and_plan(spark):
    assert ours(spark, [], OTHERS) == [] and ours(spark, OTHERS, []) == []
    side = spark.createDataFrame([(n,) for n in OTHERS], "n string")
    plan = name_candidates(side, "n", side, "n")._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
