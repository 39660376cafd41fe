"""Recall of the n-gram Jaccard join on all of a folder's documents, against brute force: python tests/llm/recall_ngram_join.py [folder]

Brute force knows nothing of the join: word tuples as sets, candidates by the prefixes that two sets of this similarity must
share, and every candidate pair compared.
"""

from __future__ import annotations

import json
import math
import sys
import tempfile
from collections import Counter, defaultdict

from pyspark.sql import SparkSession

THRESHOLD = 0.8


def shingles(text: str) -> frozenset:
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute_links(sets: list[frozenset]) -> dict[int, set[int]]:
    counts = Counter(x for s in sets for x in s)
    order = [sorted(s, key=lambda x: (counts[x], x)) for s in sets]
    index, links = defaultdict(list), defaultdict(set)
    for i, own in enumerate(order):
        near: set[int] = set()
        for x in own[: len(own) - math.ceil(THRESHOLD * len(own)) + 1]:
            near |= set(index[x])
            index[x].append(i)
        for j in near:
            shared = len(sets[i] & sets[j])
            if shared >= THRESHOLD * (len(sets[i]) + len(sets[j]) - shared):
                links[i].add(j)
                links[j].add(i)
    return links


def main(folder: str) -> None:
    from sluice.llm import ngram_join

    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-")}
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.op1_ngram_join(spark, folder).collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    spark.stop()
    members = defaultdict(list)
    for i, t in texts.items():
        if own := shingles(t):
            members[own].append(i)
    sets = list(members)
    links = brute_links(sets)
    least, seen = {}, set()
    for i in range(len(sets)):
        if i not in seen:
            part, todo = {i}, [i]
            while todo:
                for j in links.get(todo.pop(), ()):
                    if j not in part:
                        part.add(j)
                        todo.append(j)
            seen |= part
            first = min(d for j in part for d in members[sets[j]])
            least |= {d: first for j in part for d in members[sets[j]]}
    total = sum(map(len, links.values()))
    found = sum(min(got[members[s][0]][1], len(links.get(i, ()))) for i, s in enumerate(sets))
    extra = sum(max(0, got[members[s][0]][1] - len(links.get(i, ()))) for i, s in enumerate(sets))
    same = sum(got[d][0] == c for d, c in least.items())
    print(json.dumps({"documents": len(texts), "sets": len(sets), "links": total // 2, "link_recall": round(found / total, 6) if total else None, "links_too_many": extra, "documents_in_their_class": round(same / len(least), 6)}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
