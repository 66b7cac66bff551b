import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import license as lic


def wrapped(text, width=60):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


@pytest.fixture(scope="module")
def model():
    return lic.train()


def test_families_and_odd_rows(spark):
    rows = [(i, f"Invented prose of no kind.\n{t}\nMore of it.", f) for i, (f, t) in enumerate((f, t) for f, ts in lic.TEMPLATES.items() for t in ts)]
    n = len(rows)
    rows += [(n + i, t, None) for i, t in enumerate(lic.OTHERS)]
    rows += [(500, "This file is licensed under the Apache License, Version 2.0, see the link.", "Apache-2.0"), (501, "The code is released under the MIT License", "MIT"), (502, "Text here. (c) 2020 X. All rights reserved.", "Proprietary"), (503, "licensed under CC BY-NC 4.0", "CC-BY-NC")]
    odd = [(600, None, None), (601, "", None), (None, "Released under the MIT License.", "MIT"), (5, "\n\n" + "plain words " * 20_000, None), (700, "Licensed under the MIT license.", "MIT"), (700, "Licensed under the MIT license.", "MIT")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, want string").withColumn("family", F.lit("clash")).withColumn("row", F.lit("clash"))
    found = lic.scan(df).where("confirmed").collect()
    got = {(r.doc_id, r.family) for r in found}
    want = {(i, f) for i, _, f in rows + odd if f}
    assert got == want, (got - want, want - got)
    assert sum(r.doc_id == 700 for r in found) == 2
    assert lic.scan(df.limit(0)).count() == 0


def test_wrapped_texts_are_one_paragraph(spark):
    long = [(f, t) for f, ts in lic.TEMPLATES.items() for t in ts if len(t) > 120]
    df = spark.createDataFrame([(i, "Some words first.\n\n" + wrapped(t) + "\n\nAnd others.") for i, (_, t) in enumerate(long)], "doc_id long, text string")
    rows = lic.scan(df).where("confirmed").collect()
    want = {(i, f, 1) for i, (f, _) in enumerate(long)}
    assert want <= {(r.doc_id, r.family, r.paragraph) for r in rows}
    # A line that confirms a family speaks for its paragraph; no other family is found in one as a whole.
    assert {(r.doc_id, r.family, r.paragraph) for r in rows if r.line is None} <= want


def test_gate_loses_nothing(model):
    rnd = random.Random(3)
    words = sorted({a for g in model.weights for a in g.split()})
    have = set(lic.cues(model))
    assert have
    lines = ["MIT License", "Apache License, Version 2.0, January 2004", "Distributed under the MIT license", "Available under the Apache 2.0 license", *(" ".join(rnd.choices(words, k=rnd.randint(1, 30))) for _ in range(3000))]
    passed = 0
    for t in lines:
        if model.scores(t).max() > 0:
            passed += 1
            assert have & set(lic.WORD.findall(t.lower())), t
    assert passed > 100


def test_scores_equal_plain_sums(spark, model):
    rnd = random.Random(8)
    words = sorted({a for g in model.weights for a in g.split()}) + ["zzz", "qqq"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(1, 40))) for _ in range(60)] + [t for ts in lic.TEMPLATES.values() for t in ts]
    got = {r.id: r for r in lic.scored(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        best = model.scores(t).max()
        assert (i in got) == (best > 0) or abs(best) < 1e-4
        if i in got:
            assert abs(got[i].best - best) < 1e-3


def test_calibration_is_held_out(model):
    """Variants of the statements, which don't train, are named right far more often than not; other texts aren't."""
    a, b = lic.calibrate(model, [])
    sure = lambda t: 1 / (1 + np.exp(-(a * model.scores(t).max() + b))) >= 0.5
    right = [(f, v) for f, ts in lic.TEMPLATES.items() for t in lic.statements(ts) for v in lic.variants(t)]
    hit = sum(bool(sure(v)) and model.families[int(model.scores(v).argmax())] == f for f, v in right)
    assert hit / len(right) > 0.9
    assert sum(bool(sure(t)) for t in lic.OTHERS) == 0
    high = lic.calibrate(model, [(3.0, 1000)])
    assert 1 / (1 + np.exp(-(high[0] * 3 + high[1]))) < 0.5


def test_lines_that_are_no_templates(spark):
    want = [("Apache License, Version 2.0", "Apache-2.0"), ("Distributed under the MIT license", "MIT"), ("Available under the Apache 2.0 license", "Apache-2.0"), ("MIT License", "MIT")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)] + [(100 + i, t) for i, t in enumerate(lic.OTHERS)], "doc_id long, text string")
    assert {(r.doc_id, r.family) for r in lic.scan(df).collect()} == {(i, f) for i, (_, f) in enumerate(want)}
