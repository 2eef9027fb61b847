"""Line dedup against a plain reading of its rule."""

import random
from collections import defaultdict

import pytest

from feedloom.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, least_points=20, least_documents=3):
    held = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_points:
                held[key(line)].add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items() if len(ids) >= least_documents}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def made_rows():
    r = random.Random(2)
    pool = [f"{'Passage' if k % 3 else 'pássage'} number {k} that documents share" for k in range(12)] + ["short", "", "  ", "x" * 19, "é" * 20]
    rows = [(i, "\n".join(r.choice([str.upper, str, lambda s: f"\t {s} \r"])(r.choice(pool)) for _ in range(r.randint(1, 9)))) for i in range(30)]
    rows += [(3, "one more row of document three\n" + pool[1]), (None, pool[2] + "\n" + pool[2]), (None, pool[4]), (40, None), (41, ""), (42, "\n\n"),
             (43, "\n".join(f"line {k} of a text that repeats it" for k in range(3000))), (44, "\n".join(f"LINE {k} of a text that repeats it" for k in range(0, 3000, 2))),
             (45, "\n".join(f" line {k} of a text that repeats it" for k in range(0, 3000, 3))), rows[5]]
    return rows


def result(df, **kw):
    return sorted(map(repr, (tuple(r) for r in line_dedup.drop_shared_lines(df, **kw).select("doc_id", "text", "n_lines", "n_dropped").collect())))


@pytest.mark.parametrize("points,documents", [(20, 3), (1, 2), (5, 20)])
def test_equals_the_plain_rule(spark, points, documents):
    rows = made_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(df, least_points=points, least_documents=documents) == sorted(map(repr, brute(rows, points, documents)))


def test_lines_repeated_inside_a_document_count_once(spark):
    rows = [(1, "a line of twenty and more characters\n" * 5), (2, "a line of twenty and more characters")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(map(repr, brute(rows)))


@pytest.mark.parametrize("name", ["hostile", "clashing", "nothing"])
def test_defined_results(request, name):
    df = request.getfixturevalue(name)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(df) == sorted(map(repr, brute(rows)))
    assert line_dedup.drop_shared_lines(df, carry=df.columns).count() == len(rows)


def test_main_path_is_native(spark, hostile):
    plan = line_dedup.drop_shared_lines(hostile)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_one_document_at_least_is_an_error(hostile):
    with pytest.raises(ValueError):
        line_dedup.drop_shared_lines(hostile, least_documents=1)
