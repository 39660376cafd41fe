"""Leads against what portals know, with keys that many leads and deals share."""

import random

import pytest

from sluice.functions import ranks, staging
from sluice.operators import gates
from sluice.plans import companies, registered

DATA = "/root/testdata/sf0.001"
KINDS = {"domain": "domain", "page": "page"}


def some(spark, seed):
    """Leads, some of them twice with other values, and deals; one domain is that of many of both."""
    rng = random.Random(seed)
    pick = lambda k, n: rng.choice([None, "hot", *(f"{k}{i}" for i in range(n))])
    leads = [(rng.randint(0, 60), pick("d", 5), pick("p", 30)) for _ in range(90)]
    index = [(rng.choice(["domain", "page"]), rng.choice([pick("d", 5), pick("p", 30)]), f"p{rng.randint(0, 2)}", rng.randint(0, 40), rng.random() < 0.2) for _ in range(300)]
    met = {(lead, kind, portal, deal) for lead, d, p in leads for kind, value, portal, deal, gone in index if not gone and value is not None and value == {"domain": d, "page": p}[kind]}
    return spark.createDataFrame(leads, "lead long, domain string, page string"), spark.createDataFrame(index, "kind string, value string, portal string, deal long, is_archived boolean"), met


@pytest.mark.parametrize("seed", range(3))
def test_hits_by_slices(seed, spark, monkeypatch):
    monkeypatch.setattr(gates, "SLICE", 4)
    leads, index, met = some(spark, seed)
    assert sorted(map(tuple, gates.dedup_hits(leads, index, KINDS).collect())) == sorted(met)


@pytest.mark.parametrize("sizes", [{"MANY": 2, "TILE": 3}, {"LEADS": 2}, {"SLICE": 5, "SLICES": 3}, {"MANY": 4, "TILE": 2, "LEADS": 9, "SLICE": 8, "SLICES": 7}])
def test_hits_by_slices_and_tiles(sizes, spark, monkeypatch):
    for name, n in sizes.items():
        monkeypatch.setattr(gates, name, n)
    leads, index, met = some(spark, 7)
    leads = leads.union(spark.sql("SELECT CAST(NULL AS LONG), 'hot', 'hot'"))
    met |= {(None, kind, portal, deal) for kind, value, portal, deal, gone in index.collect() if value == "hot" and not gone}
    order = lambda rows: sorted(rows, key=str)
    assert order(map(tuple, gates.dedup_hits(leads, index, KINDS).collect())) == order(met)


def test_pairs_are_not_staged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    hits = registered()[0]["dedup_leads"](spark, DATA)
    assert hits.count() > 0 and {p.name.split("-")[0] for p in tmp_path.iterdir()} == {"leads", "deals"}


@pytest.mark.parametrize("seed", range(3))
def test_hits_are_explained_from_counts(seed, spark):
    leads, index, met = some(spark, seed)
    want = {}
    for lead, kind, portal, deal in met:
        want.setdefault(lead, []).append(f"{portal}:{kind}:{deal}")
    got = {r.lead: (r.hits, r.why) for r in gates.dedup_explain(leads, index, KINDS).collect()}
    assert got == {lead: (len(w), " ".join(sorted(w)[:3])) for lead, w in want.items()}
    assert sorted(r.lead for r in gates.met_leads(leads, index, KINDS).collect()) == sorted(want)


def made(*_):
    raise AssertionError("pairs of leads and deals are made")


@pytest.mark.parametrize("name", ["dedup_explain", "campaign_chain", "push_plan", "move_plan"])
def test_no_pairs_are_made(name, spark, monkeypatch):
    monkeypatch.setattr(gates, "dedup_hits", made)
    assert registered()[0][name](spark, DATA).count() > 0


@pytest.mark.parametrize("name", ["company_golden", "merge_pointer_problems"])
def test_companies_are_derived_by_many_tasks(name, spark, monkeypatch):
    seen = []
    monkeypatch.setattr(companies.norm, "applied", lambda raw, rules, plain=companies.norm.applied: seen.append(raw.rdd.getNumPartitions()) or plain(raw, rules))
    assert registered()[0][name](spark, DATA).count() > 0
    assert seen == [4]


@pytest.mark.parametrize("name", ["campaign_gate", "round_robin_assignment"])
def test_leads_are_derived_once(name, spark, monkeypatch):
    seen = []
    for module in (companies, ranks):
        monkeypatch.setattr(module, "staged", lambda df, *a, plain=module.staged: seen.append(len(df.columns)) or plain(df, *a))
    assert registered()[0][name](spark, DATA).count() > 0
    assert seen in ([4], [3])


@pytest.mark.parametrize("name", ["merge_pointer_problems", "link_golden", "identifier_survivor"])
def test_names_are_not_derived_for_linking(name, spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(companies, "staged", lambda df, label, plain=companies.staged: seen.setdefault(label, df.columns) and plain(df, label))
    assert registered()[0][name](spark, DATA).count() > 0
    assert {"entity", "domain"} <= set(seen["companies"]) and not {"name_key", "name_norm"} & set(seen["companies"])
