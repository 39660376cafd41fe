"""Linking of companies and contacts against the same rules followed row by row."""

import random

import pytest

from sluice.functions import staging
from sluice.operators import audits, identity, importers, report

TYPES = [("domain", "domain"), ("page", "page"), ("register", "register")]


def linked(spark, entities):
    rows = spark.createDataFrame(entities, "entity long, source string, domain string, page string, register string")
    ids = identity.identifiers(rows, TYPES)
    claims = identity.strong_claims(ids).cache()
    return rows, ids, claims, identity.golden(rows, claims).cache()


def one_by_one(ids):
    """entity -> (company, key that linked it), the pairs of companies that an entity's keys disagree on, and the owner of each key."""
    by_entity, owner, where, pairs = {}, {}, {}, set()
    for r in ids:
        by_entity.setdefault(r.entity, []).append((r.priority, r.type, r.value))
    for entity in sorted(by_entity):
        keys = sorted(by_entity[entity])
        hits = [(owner[k[1:]], k[1]) for k in keys if k[1:] in owner]
        where[entity] = hits[0] if hits else (entity, "new")
        own = where[entity][0]
        pairs |= {(min(own, o), max(own, o)) for o, _ in hits if o != own}
        for k in keys:
            owner.setdefault(k[1:], own)
    return where, pairs, owner


def test_companies_are_never_merged(spark):
    rows, ids, claims, labels = linked(spark, [(1, "a", "d", None, None), (2, "b", None, "p", None), (3, "c", "d", "p", None)])
    assert {r.entity: (r.golden, r.how) for r in labels.collect()} == {1: (1, "new"), 2: (2, "new"), 3: (1, "domain")}
    assert [(r.left, r.right, r.types, r.score) for r in identity.conflicts(claims, labels).collect()] == [(1, 2, "page", 0.9)]
    assert {(r.source, r.type): r.links for r in audits.key_links(rows, labels).collect()} == {("c", "domain"): 1}
    assert {r.type: r.identifiers for r in audits.confirmed(identity.owned(claims, labels)).collect()} == {"domain": 1}
    keys = {r.golden: (r.domain, r.page) for r in identity.golden_keys(claims, labels, ["domain", "page"]).collect()}
    assert keys == {1: ("d", None), 2: (None, "p")}


@pytest.mark.parametrize("seed", range(4))
def test_linking_is_that_of_rows_one_after_another(spark, seed):
    rng = random.Random(seed)
    key = lambda k, n: None if rng.random() < 0.3 else f"{k}{rng.randint(0, n)}"
    entities = [(i, f"s{rng.randint(0, 40)}", key("d", 60), key("p", 50), key("r", 70)) for i in rng.sample(range(1000), 200)]
    _, ids, claims, labels = linked(spark, entities)
    strong = [r for r in ids.collect() if r.strength == "strong"]
    where, pairs, owner = one_by_one(strong)
    assert {r.entity: (r.golden, r.how) for r in labels.collect()} == {e[0]: where.get(e[0], (e[0], "new")) for e in entities}
    assert {(r.left, r.right) for r in identity.conflicts(claims, labels).collect()} == pairs and pairs
    assert all(r.owner == owner[r.type, r.value] for r in identity.owned(claims, labels).collect())


def test_a_long_chain_and_a_hot_key(spark):
    chain = [(i, f"s{i}", f"d{i // 2}", f"p{(i + 1) // 2}", None) for i in range(200)]
    hot = [(1000 + i, f"t{i}", "hot", None, None) for i in range(300)]
    *_, labels = linked(spark, chain + hot)
    got = {r.entity: r.golden for r in labels.collect()}
    assert all(got[e[0]] == 0 for e in chain) and all(got[e[0]] == 1000 for e in hot)


def test_no_companies(spark):
    rows, ids, claims, labels = linked(spark, [])
    assert labels.count() == 0 and identity.conflicts(claims, labels).count() == 0


def test_names_are_those_of_companies(spark):
    rows = spark.createDataFrame([(1, ["a"], "blue sky", "blue sky", "Ulm", None), (2, ["b"], "blue sky", "blue  sky ltd", "ULM", "DE"), (3, ["a"], "blue sky", "blue sky", None, None), (4, ["a", "b"], "red sea", "red sea", None, None), (5, ["a"], "red sea", "red sea", None, "FR")], "golden long, sources array<string>, name_key string, name_norm string, city string, country string")
    assert sorted((r.left, r.right, r.score) for r in identity.name_candidates(rows).collect()) == [(1, 2, 0.7), (2, 3, 0.6), (4, 5, 0.75)]


def contacts_one_by_one(rows):
    keys, out = {}, {}
    for pk, company, page, mail in sorted(rows, key=lambda r: r[0]):
        own = [(k, v) for k, v in (("linkedin", page), ("email", mail)) if v is not None]
        hit = next(((keys[company, k, v], k) for k, v in own if (company, k, v) in keys), None)
        out[pk] = hit or (pk, "new")
        if not hit:
            keys.update({(company, k, v): pk for k, v in own})
    return out


CONTACTS = "pk long, company long, linkedin string, email string"


def test_only_contacts_have_keys(spark):
    rows = spark.createDataFrame([(1, 9, None, "a"), (2, 9, "L", "a"), (3, 9, "L", None), (4, 8, "L", None), (5, None, "L", None), (6, None, "L", "x"), (7, 9, None, None)], CONTACTS)
    linked = importers.contact_upsert(rows)
    assert {r.pk: (r.contact, r.method) for r in linked.collect()} == {1: (1, "new"), 2: (1, "email"), 3: (3, "new"), 4: (4, "new"), 5: (5, "new"), 6: (5, "linkedin"), 7: (7, "new")}
    assert sorted((r.left, r.right) for r in importers.contact_candidates(rows, linked).collect()) == [(3, 4), (3, 5)]


@pytest.mark.parametrize("seed", range(3))
def test_contacts_are_those_of_rows_one_after_another(spark, seed):
    rng = random.Random(seed)
    pick = lambda k, n: None if rng.random() < 0.2 else f"{k}{rng.randint(0, n)}"
    rows = [(pk, rng.choice([None, 1, 1, 1, 2, 3]), pick("l", 25), pick("e", 25)) for pk in rng.sample(range(500), 150)]
    got = importers.contact_upsert(spark.createDataFrame(rows, CONTACTS))
    assert {r.pk: (r.contact, r.method) for r in got.collect()} == contacts_one_by_one(rows)
    assert importers.contact_upsert(spark.createDataFrame([], CONTACTS)).count() == 0


def test_pipelines_of_stages(spark):
    events = spark.createDataFrame([(i, d, s, 10) for i, (d, s) in enumerate([(1, "one"), (1, "two"), (2, "two"), (3, "two"), (1, "gone"), (2, "gone"), (3, "gone")])], "event_id long, deal_id long, stage_id string, entered_at int")
    stages = spark.createDataFrame([("one", 5), ("two", 6), ("two", 7)], "stage_id string, pipeline long")
    history = spark.createDataFrame([(1, 3, 7), (2, 20, 9)], "deal_id long, at int, pipeline long")
    current = spark.createDataFrame([(1, 7), (2, 6), (3, None)], "deal_id long, pipeline long")
    got = {r.event_id: (r.pipeline, r.basis) for r in report.resolve_pipeline(events, stages, history, current).collect()}
    assert got == {0: (5, "unique_stage_id"), 1: (7, "pipeline_history"), 2: (6, "deal_current"), 3: (None, "unresolved"), 4: (7, "pipeline_history"), 5: (9, "pipeline_history"), 6: (None, "unresolved")}


def test_queries_leave_their_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    made = staging.tidy("out", lambda s, d: staging.staged(staging.staged(s.range(3).toDF("x"), "a").filter("x > 0"), "b").select("x"))(spark, "")
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["out"] and made.count() == 2
    assert staging.tidy("out", lambda s, d: s.range(2).toDF("x"))(spark, "").count() == 2 and len(list(tmp_path.iterdir())) == 1


def test_survivors_read_a_round_once(spark):
    """Rounds that were only planned would read the pointers 2^5 times."""
    rows = [(i, i // 3 if i % 3 == 0 and i else None) for i in range(200)] + [(201, 202), (202, 201), (203, 203), (204, 999), (205, 206), (206, 207), (207, 205)]
    to, want = dict(rows), {}
    for e, _ in rows:
        path = [e]
        for _ in range(32):
            if path[-1] in to and to[path[-1]] is not None:
                path.append(to[path[-1]])
        want[e] = path[-1] if path[-1] in to and to[path[-1]] is None else min(path)
    got = identity.survivors(spark.createDataFrame(rows, "entity long, merged_into long"))
    assert {r.entity: r.survivor for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") <= 1


def test_merge_pointers_are_followed_to_their_end(spark):
    """A chain of 90 entities, which a bound on its steps would call a cycle, and a cycle of 45 with a chain of 40 that leads to it."""
    chain, ring, tail = [(i, i - 1 if i else None) for i in range(90)], [(200 + i, 200 + (i + 1) % 45) for i in range(45)], [(300 + i, 300 + i - 1 if i else 200) for i in range(40)]
    pointers = spark.createDataFrame(chain + ring + tail, "entity long, merged_into long")
    assert {r.entity: r.survivor for r in identity.survivors(pointers).collect()} == {e: 0 if e < 90 else 200 for e, _ in chain + ring + tail}
    labels = pointers.select("entity", pointers["entity"].alias("golden"))
    assert {(r.entity, r.problem) for r in identity.pointer_problems(pointers, labels).collect()} == {(e, "cycle") for e, _ in ring + tail}


def test_claims_are_counted_only_if_read(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "a", None)], "entity long, source string, domain string")
    ids = identity.identifiers(rows, [("domain", "domain")])
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert (joins(ids), joins(ids.drop("claims"))) == (2, 1)
    assert sorted((r.entity, r.claims) for r in ids.collect()) == [(1, 2), (2, 2)]
