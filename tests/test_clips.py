"""Clips of long files are compared in runs."""

import random

from quire.operators import checks


def test_late_clips_are_found_in_and_between_runs(spark, monkeypatch):
    monkeypatch.setattr(checks, "RUN_BITS", 3)
    rng, rows, want = random.Random(5), [], []
    for smil in ("a.smil", "b.smil"):
        end = None
        for o in sorted(rng.sample(range(400), 60)):
            begin = rng.randrange(1000)
            if end is not None and begin < end:
                want.append((smil, o))
            end = begin + rng.randrange(1, 300)
            rows.append(("book.opf", smil, o, begin, end))
    clips = spark.createDataFrame(rows, "opf string, smil string, ord long, begin long, end long").repartition(5)
    found = checks._late(clips)
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) > 20
    # no task has all clips of a file, but only their runs
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(opf" in plan and "run" in plan.split("Window")[1].split("\n")[0]
