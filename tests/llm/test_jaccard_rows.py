"""How often the token rows of the n-gram join are made."""

import collections
import random
import re

from huddle.llm import jaccard


def test_tokens_are_counted_in_one_shuffle(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(300) for _ in range(6)] + [7]) for i in range(80)]
    sets = spark.createDataFrame([(i, t, [2 * i] * len(t)) for i, t in rows], "id long, tokens array<long>, needs array<int>")
    found = jaccard.shared_tokens(sets)
    held = collections.Counter(x for _, t in rows for x in t)
    want = collections.Counter((x, i, 2 * i, held[x]) for i, t in rows for x in t if held[x] > 1)
    assert collections.Counter((r.token, r.id, r.need, r.held) for r in found.collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1
    assert jaccard.shared_tokens(sets.limit(0)).count() == 0


def test_token_rows_meet_the_components_once(spark, monkeypatch):
    """Each table that is written reads the common tokens once: their join with the components is not made anew by each use."""
    rng = random.Random(6)
    base = [" ".join(f"w{rng.randrange(5000)}" for _ in range(120)) for _ in range(4)]
    rows = []
    for i in range(60):
        words = base[i % 4].split()
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9000)}"
        rows.append((i, " ".join(words)))
    plans, plain = [], jaccard.written

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return plain(df, name)

    monkeypatch.setattr(jaccard, "written", seen)
    assert jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), percent=80, width=5).count() == 60
    reads = {name: len([c for c in re.findall(r"Relation \[([^\]]*)\]", p) if "need#" in c and "token#" in c and "rank" not in c and "component" not in c and "held#" not in c]) for name, p in plans}
    assert "jaccard-held" in reads and max(reads.values()) == 1, reads
