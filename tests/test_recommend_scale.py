"""What the recommenders hold and move as their tables grow."""

import numpy as np

from feedloom.operators import label
from feedloom.plans import contract_queries, queries, recommend_queries
from feedloom.recommend import content, factorize, item_item, pairs, popularity, split
from feedloom.session import materialize

PAIR = "user_id string, item_id string"


def watched(monkeypatch, module):
    """Rows of what ``module`` writes, by name."""
    written = {}

    def write(df, name="table"):
        out = materialize(df, name)
        written[name] = out
        return out

    monkeypatch.setattr(module, "materialize", write)
    return written


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_free_places_are_looked_for_among_the_first_only(spark):
    held = spark.createDataFrame([("u", 0), ("u", 2), ("v", 4095)], "user_id string, place int")
    who = spark.createDataFrame([("u",), ("v",), ("w",)], "user_id string")
    got = popularity._free_places(held, who, 9000, 3, 4096)
    assert "size(places" in plan(got)
    assert sorted((r.user_id, r.place) for r in got.collect()) == [(u, p) for u, ps in (("u", (1, 3, 4)), ("v", (0, 1, 2)), ("w", (0, 1, 2))) for p in ps]


def test_light_users_make_pairs_from_one_list(spark, monkeypatch):
    def never(*_):
        raise AssertionError("no user is heavy")

    monkeypatch.setattr(item_item, "pairs_sharing", never)
    likes = spark.createDataFrame([(u, i) for u in ("a", "b") for i in ("x", "y", "z")] + [("c", "x"), ("c", "lone")], PAIR)
    got = item_item.co_occurrence(likes, 2, 0.0).collect()
    assert sorted(map(tuple, got)) == [("x", "y", 2, 3, 2), ("x", "z", 2, 3, 2), ("y", "z", 2, 2, 2)]


def test_classes_of_copies_bring_few_rows_to_a_list(spark, monkeypatch):
    written = watched(monkeypatch, content)
    items = spark.createDataFrame([(f"{w}{k:02d}", f"red {w}") for w in "abcdef" for k in range(30)], "item_id string, item_text string")
    got = content.content_neighbours(items, 4, 0.01).collect()
    assert [len(r.list) for r in written["lists"].collect()] == [5] * 6
    near = {}
    for r in got:
        near.setdefault(r.item_id, []).append((r.rank, r.other_id))
    assert len(near) == 180 and all(len(x) == 4 for x in near.values())
    assert sorted(near["b01"]) == [(1, "b00"), (2, "b02"), (3, "b03"), (4, "b04")]


def test_pairs_are_made_in_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    monkeypatch.setattr(pairs, "PAIRS", 1000)
    rows = spark.createDataFrame([("hot", k) for k in range(200)], "k string, x int")
    got = pairs.pairs_sharing(rows, "k", "x", 16)
    assert got.count() == 200 * 199 // 2
    assert "RepartitionByExpression [key" in plan(got) and ", 20" in plan(got)


def test_liked_lists_meet_once_by_user(spark, monkeypatch):
    monkeypatch.setattr(pairs, "LIKES", 1)
    likes = spark.createDataFrame([("u", "a"), ("u", "b"), ("v", "b")], PAIR)
    near = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.5), ("b", "c", 0.25), ("b", "d", 0.75)], "item_id string, other_id string, similarity double")
    seen = likes.unionByName(spark.createDataFrame([("v", "d"), ("w", "c"), (None, "c")], PAIR))
    users = spark.createDataFrame([("u",), ("u",), ("v",), ("w",), (None,)], "user_id string")
    got = pairs.recommend_by_neighbours(likes, near, seen, users, 2)
    assert sorted(map(tuple, got.select("user_id", "item_id", "rank", "score").collect())) == [("u", "c", 1, 0.75), ("u", "d", 2, 0.75), ("v", "c", 1, 0.25)]


def test_users_meet_only_items_long_enough(spark, monkeypatch):
    r = np.random.default_rng(4)
    users, items = r.normal(size=(40, 4)), r.normal(size=(300, 4)) * 0.98 ** np.arange(300)[:, None]
    items[250:] = 0.0  # one length for many
    tables = [spark.createDataFrame([(n, [float(x) for x in v]) for n, v in enumerate(t)], "id int, vector array<double>") for t in (users, items)]
    model = factorize.Factors(*tables, 3.0, 0.1)
    seen = [(u, int(i)) for u in range(40) for i in np.argsort(-items @ users[u])[:u % 7]]
    written = watched(monkeypatch, factorize)
    got = factorize.recommend_factorised(model, spark.createDataFrame(seen, "user_idx int, item_idx int"), tables[0].select(tables[0].id.alias("user_idx")), 5, 20).collect()
    want = {u: sorted((-(users[u] * v).sum(), i) for i, v in enumerate(items) if (u, i) not in set(seen))[:5] for u in range(40)}
    assert {(x.user_idx, x.rank): x.item_idx for x in got} == {(u, k): i for u, x in want.items() for k, (_, i) in enumerate(x, 1)}
    assert written["asked"].count() < 40 * 14 / 2
    same = factorize.recommend_factorised(model, spark.createDataFrame(seen, "user_idx int, item_idx int"), tables[0].select(tables[0].id.alias("user_idx")), 60, 7)
    assert same.groupBy("user_idx").count().where("count = 60").count() == 40


def test_ratings_and_vectors_are_moved_once(spark, monkeypatch):
    """Rows that a shuffle brings while vectors are fitted: none, whatever the number of half-steps."""
    monkeypatch.setattr(factorize, "PAGE_BITS", 3)
    r = np.random.default_rng(6)
    rows = [(u, i, float(r.integers(1, 6))) for u in range(60) for i in range(50) if r.random() < 0.3]
    dealt = factorize.deal(spark.createDataFrame(rows, "user_idx int, item_idx int, rating double"), 100)
    assert len(dealt.by_user.pieces) > 4 and len(dealt.by_item.pieces) > 4
    made, by_piece, tables = [], factorize._by_piece, []

    def looked_at(*args):
        made.append(by_piece(*args))
        return made[-1]

    monkeypatch.setattr(factorize, "_by_piece", looked_at)
    monkeypatch.setattr(factorize, "materialize", lambda df, name="table": tables.append(name))
    losses = []
    model = factorize.factorise(dealt, 3, 2, watch=lambda m: losses.append(factorize.loss(dealt, m).first()))
    assert len(made) == 2 * 3 and not tables
    for df in made:
        assert df.rdd.getNumPartitions() > 4 and not any(w in df._jdf.queryExecution().executedPlan().toString() for w in ("Exchange", "Join"))
    p, q = ({x.id: np.array(x.vector) for x in t.collect()} for t in (model.users, model.items))
    mean = sum(x for *_, x in rows) / len(rows)
    error = sum((x - mean - p[u] @ q[i]) ** 2 for u, i, x in rows)
    assert losses[1].ratings == len(rows) and np.isclose(losses[1].rmse, (error / len(rows)) ** 0.5, rtol=1e-12)
    assert np.isclose(losses[1].objective, error + 0.1 * sum(p[u] @ p[u] + q[i] @ q[i] for u, i, _ in rows), rtol=1e-12)


def test_loss_of_rows_without_a_vector_or_a_rating(spark):
    model = factorize.Factors(*[spark.createDataFrame([(3, [1.0, 2.0]), (70000, [0.5, 0.0])], "id int, vector array<double>")] * 2, 2.0, 0.1)
    rows = spark.createDataFrame([(3, 3, 4.0), (3, 9, 1.0), (None, 70000, 5.0), (70000, 3, None)], "user_idx int, item_idx int, rating double")
    got = factorize.loss(rows, model).first()
    assert got.ratings == 4 and np.isclose(got.rmse, (9 / 4) ** 0.5)
    assert np.isclose(got.objective, 9 + 0.1 * (2 * 5 + 0.25 + 2 * 5 + 0.25))
    assert tuple(factorize.loss(rows.where("false"), model).first()) == (None, None, None)


def test_interactions_are_written_once(spark, monkeypatch, tmp_path):
    written = watched(monkeypatch, recommend_queries)
    rows = spark.createDataFrame([("u", "i", t, 4.0, t, True) for t in range(10)], "user_id string, item_id string, timestamp_ms long, rating float, ordinal long, verified_purchase boolean")
    monkeypatch.setattr(recommend_queries, "events_interactions", lambda *_: rows)
    assert recommend_queries.parted(spark, "", "events").groupBy("split").count().count() == 3
    assert list(written) == ["events-interactions"] and "verified_purchase" not in written["events-interactions"].columns


def test_stored_tables_are_written_where_they_stay(spark, monkeypatch):
    def never(*_):
        raise AssertionError("written twice")

    monkeypatch.setattr(queries, "materialize", never)
    monkeypatch.setattr(queries, "lines_interactions", lambda *_: spark.createDataFrame([("u", "i1", 5.0, 1000, True, 0, 7)], "user_id string, item_id string, rating float, timestamp_ms long, verified_purchase boolean, helpful_votes int, ordinal long").selectExpr("*", "timestamp_millis(timestamp_ms) as event_time"))
    raw = "ordinal long, parent_asin string, title string, description array<string>, features array<string>, store string, categories array<string>, price double, average_rating double, rating_number int"
    monkeypatch.setattr(contract_queries.fx, "raw_items", lambda *_: spark.createDataFrame([(1, "i1", "t", ["d"], ["f"], "s", ["c"], 1.0, None, 3)], raw))
    assert contract_queries.q_stored_label_summary(spark, "").first().interactions == 1


def test_labels_are_added_after_the_sort(spark):
    rows = spark.createDataFrame([("u", "i", 5.0, 1000, 1)], "user_id string, item_id string, rating float, timestamp_ms long, ordinal long").selectExpr("*", "timestamp_millis(timestamp_ms) as event_time")
    assert plan(label.label_interactions(rows)).startswith("Project")


def test_factorised_metrics_clean_and_judge_what_is_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(recommend_queries, "materialize", lambda df, name="table": written.append(name) or materialize(df, name))
    r = np.random.default_rng(8)
    rows = [(f"u{r.integers(12)}", f"i{r.integers(9)}", float(r.integers(1, 6)), 1000 + t, t) for t in range(200)]
    rows = spark.createDataFrame(rows, "user_id string, item_id string, rating float, timestamp_ms long, ordinal long")
    monkeypatch.setattr(recommend_queries, "lines_interactions", lambda *_: rows)
    got = recommend_queries.q_factorised_metrics("lines")(spark, "").collect()
    assert written.count("lines-interactions") == 1 and written.count("relevant") == 1
    relevant = split.held_out_relevance(split.chronological_split(rows))
    assert {(x.k, x.users) for x in got} == {(k, relevant.select("user_id").distinct().count()) for k in recommend_queries.KS}


def test_users_meet_only_items_in_their_direction(spark, monkeypatch):
    """Items of one length, which lengths part in nothing: users of like directions are scored against few of them."""
    r = np.random.default_rng(9)
    towards = np.repeat(factorize._directions(r.normal(size=(6, 4))), 50, axis=0) + r.normal(size=(300, 4)) * 0.02
    items, met = factorize._directions(r.normal(size=(3000, 4))), []
    monkeypatch.setattr(factorize, "SEEDS", 32)

    class Ends:
        __array_ufunc__ = None

        def __init__(self, a):
            self.a = a

        def __rmatmul__(self, x):
            return x @ self.a

        def __getitem__(self, key):
            met.append(len(key[1]))
            return self.a[key]

    groups = factorize._alike(towards)
    assert sorted(np.concatenate(groups)) == list(range(300)) and max(map(len, groups)) <= factorize.PEOPLE
    for who in groups:
        p, seen = towards[who], r.integers(0, 3000, (2, 500))
        seen[0] %= len(who)
        u, i, product = factorize._scan(p, items, Ends(items.T), np.linalg.norm(items, axis=1), np.full(len(who), -np.inf), seen[0], seen[1], 5)
        scores = (p[:, None] * items).sum(axis=2)
        scores[seen[0], seen[1]] = -np.inf
        want = np.argsort(-scores, axis=1, kind="stable")[:, :5]
        assert sorted(zip(u, i)) == sorted((n, x) for n, xs in enumerate(want) for x in xs)
        assert np.array_equal(product, scores[u, i])
    assert sum(met) < len(groups) * 3000 / 2


def test_users_of_like_directions_share_a_block(spark):
    r = np.random.default_rng(10)
    users = [(n, [float(x) for x in v]) for n, v in enumerate(r.normal(size=(400, 3)))] + [(400, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(users, "id int, vector array<double>")
    blocks = {}
    for x in factorize._by_direction(df, 3, 50).collect():
        blocks.setdefault(x.r, []).append((x.id, x.vector))
    assert sorted(y for x in blocks.values() for y in x) == users
    assert 8 <= len(blocks) <= 16 and min(blocks) == 0 and max(blocks) == len(blocks) - 1 and max(map(len, blocks.values())) <= 100
    near = [x for x in blocks.values() if len(x) > 1]
    inside = np.mean([np.linalg.norm(factorize._directions(np.array([v for _, v in x])).mean(axis=0)) for x in near])
    assert inside > 0.6  # of users dealt by id: about 0.15
    one = factorize._by_direction(df.where("false"), 3, 50)
    assert one.collect() == []


def test_equal_vectors_and_vectors_without_length(spark):
    """Every item ties with every other: the first by index go on, and of a cell no more than k a user."""
    tables = [spark.createDataFrame([(n, v) for n in range(m)], "id int, vector array<double>") for m, v in ((90, [0.0, 0.0]), (70, [0.5, 0.25]))]
    for users, items in (tables, tables[::-1]):
        got = factorize.recommend_factorised(factorize.Factors(users, items, 3.0, 0.1), spark.createDataFrame([(1, 0), (1, 2)], "user_idx int, item_idx int"),
                                             users.select(users.id.alias("user_idx")), 3, 16).collect()
        lists = {}
        for x in got:
            lists.setdefault(x.user_idx, {})[x.rank] = x.item_idx
        assert lists == {u: dict(zip((1, 2, 3), (1, 3, 4) if u == 1 else (0, 1, 2))) for u in range(users.count())}
    found = factorize._scan(np.zeros((40, 2)), np.ones((9000, 2)), np.ones((2, 9000)), np.full(9000, 2**0.5), np.full(40, -np.inf), np.empty(0, int), np.empty(0, int), 4)
    assert len(found[0]) == 40 * 4 and set(found[1]) == {0, 1, 2, 3}
