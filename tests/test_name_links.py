"""Links of names by classes of copies against all pairs."""

import difflib
import random
from collections import Counter

from sluice.operators import projection


def test_copies_lose_no_link_and_are_not_expanded(spark, monkeypatch):
    rng = random.Random(4)
    names = ["acme labs", "acme lab", "acme", "zeta", "zeta labs", "blue ring", "red ring", None]
    a, b = ([(i, rng.choice(names), rng.choice(["x", "y", None])) for i in range(s, s + 120)] for s in (0, 1000))
    alike = lambda x, y: max(difflib.SequenceMatcher(None, x, y).ratio(), 0.85 if x in y or y in x else 0)
    want = {(i, j): alike(x, y) for i, x, p in a for j, y, q in b if p and p == q and x and y and alike(x, y) >= 0.55}
    rows = projection.name_links(*(spark.createDataFrame(r, "id long, name string, block string") for r in (a, b))).collect()
    left, right = ({r.a: r for r in rows if r.kind == k} for k in ("left", "right"))
    pairs = {(r.a, r.b): r for r in rows if r.kind == "pair"}
    got = {(i, j): pairs[x.b, y.b].similarity for i, x in left.items() for j, y in right.items() if (x.b, y.b) in pairs}
    assert got == want and len(pairs) <= 2 * 49 and sum(r.links for r in pairs.values()) == len(want)
    assert len(left) == len(right) == 120
    assert {i: r.links for i, r in left.items() if r.links} == Counter(i for i, _ in want) and {j: r.links for j, r in right.items() if r.links} == Counter(j for _, j in want)
