"""DuckDB SQL of the recommenders and their evaluation, written from their formulas."""

from __future__ import annotations

from feedloom.plans.oracle import RAW_EVENTS, RAW_ITEMS, RAW_LINES, clean_cte, items_cte

BASE = {
    "events": ",\n".join([RAW_EVENTS, RAW_ITEMS, clean_cte("I", "raw_events"), items_cte("T", "raw_items", "I")]),
    "lines": ",\n".join([RAW_LINES, RAW_ITEMS, clean_cte("I", "raw_lines"), items_cte("T", "raw_items", "I")]),
}

def parts(train: int = 7, validation: int = 1) -> str:
    """The parts, their shares in tenths."""
    return f"""placed AS (SELECT timestamp_ms, row_number() OVER (ORDER BY timestamp_ms) - 1 AS p, count(*) OVER () AS n FROM I),
cuts AS (SELECT min(timestamp_ms) FILTER (p = n * {train} // 10) AS a, min(timestamp_ms) FILTER (p = n * {train + validation} // 10) AS b FROM placed),
S AS (
  SELECT I.*, CASE WHEN timestamp_ms < a THEN 'train' WHEN timestamp_ms < b THEN 'validation' ELSE 'test' END AS split FROM I, cuts),
train AS (SELECT * FROM S WHERE split = 'train'),
relevant AS (
  SELECT DISTINCT user_id, item_id FROM S WHERE split = 'test' AND rating >= 4
  EXCEPT SELECT user_id, item_id FROM train),
judged AS (SELECT user_id, count(*) AS n_relevant FROM relevant GROUP BY user_id)"""

POPULAR = """popular AS (
  SELECT item_id, interactions, row_number() OVER (ORDER BY interactions DESC, item_id) AS place
  FROM (SELECT item_id, count(*) AS interactions FROM train GROUP BY item_id)),
popular_lists AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY place) AS rank, interactions AS score
  FROM judged CROSS JOIN popular
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = judged.user_id AND t.item_id = popular.item_id)
  QUALIFY rank <= 10)"""


LIKED = "liked AS (SELECT DISTINCT user_id, item_id FROM train WHERE rating >= 4)"

ITEM_NEIGHBOURS = """liked_n AS (SELECT item_id, count(*) AS n FROM liked GROUP BY item_id),
common AS (
  SELECT x.item_id, y.item_id AS other_id, count(*) AS common FROM liked x JOIN liked y ON x.user_id = y.user_id AND x.item_id <> y.item_id GROUP BY 1, 2),
neighbours AS (
  SELECT common.item_id, other_id, common, common / sqrt(CAST(a.n * b.n AS DOUBLE)) AS similarity,
    row_number() OVER (PARTITION BY common.item_id ORDER BY common / sqrt(CAST(a.n * b.n AS DOUBLE)) DESC, other_id) AS rank
  FROM common JOIN liked_n a ON a.item_id = common.item_id JOIN liked_n b ON b.item_id = other_id
  WHERE common >= 2 AND common * common >= 0.05 * 0.05 * a.n * b.n QUALIFY rank <= 20)"""

CONTENT_NEIGHBOURS = r"""terms AS (SELECT item_id, unnest(regexp_extract_all(lower(item_text), '[\p{L}\p{N}]+')) AS term FROM T),
tf AS (SELECT item_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
idf AS (
  SELECT term, ln((1.0 + (SELECT count(DISTINCT item_id) FROM tf)) / (1.0 + count(*))) + 1.0 AS idf FROM tf GROUP BY term),
weighted AS (
  SELECT item_id, term, CAST(floor(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY item_id)) * 1000000) AS BIGINT) AS w
  FROM tf JOIN idf USING (term)),
dots AS (
  SELECT x.item_id, y.item_id AS other_id, CAST(sum(x.w * y.w) AS BIGINT) AS dot FROM weighted x JOIN weighted y ON x.term = y.term AND x.item_id <> y.item_id GROUP BY 1, 2),
neighbours AS (
  SELECT item_id, other_id, dot / 1e12 AS similarity, row_number() OVER (PARTITION BY item_id ORDER BY dot DESC, other_id) AS rank
  FROM dots WHERE dot >= 0.3 * 1e12 QUALIFY rank <= 20)"""


def by_neighbours(name: str, near: str = "neighbours") -> str:
    """Lists of users with relevant items, from the CTE neighbours."""
    return f"""{name} AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY units DESC, item_id) AS rank, units / 1e9 AS score
  FROM (SELECT user_id, other_id AS item_id, CAST(sum(CAST(floor(similarity * 1000000000) AS BIGINT)) AS BIGINT) AS units
        FROM liked JOIN judged USING (user_id) JOIN {near} USING (item_id) GROUP BY ALL) s
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = s.user_id AND t.item_id = s.item_id)
  QUALIFY rank <= 10)"""


def user_metrics(lists: str) -> str:
    """Per user with relevant items and k, from a CTE of lists."""
    return f"""hits AS (
  SELECT user_id, rank, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS nth FROM {lists} JOIN relevant USING (user_id, item_id)),
ks AS (SELECT unnest([5, 10]) AS k),
sums AS (
  SELECT j.user_id, k, n_relevant, count(rank) AS hits, coalesce(sum(nth / rank), 0) AS ap, coalesce(sum(1 / log2(rank + 1)), 0) AS dcg
  FROM judged j CROSS JOIN ks LEFT JOIN hits h ON h.user_id = j.user_id AND h.rank <= k GROUP BY ALL),
scored AS (
  SELECT user_id, k, n_relevant, hits, hits / k AS precision, hits / n_relevant AS recall, ap / least(n_relevant, k) AS map,
    dcg / list_sum(list_transform(range(1, least(n_relevant, k) + 1), lambda r: 1 / log2(r + 1))) AS ndcg,
    CAST(hits > 0 AS DOUBLE) AS hit_rate FROM sums)"""


def _round(*names: str) -> str:
    return ", ".join(f"round({n}, 9) AS {n}" for n in names)


METRICS = ["precision", "recall", "map", "ndcg", "hit_rate"]
USER_METRICS = f"SELECT user_id, CAST(k AS INTEGER) AS k, n_relevant, hits, {_round(*METRICS)} FROM scored"
MEANS = "CAST(k AS INTEGER) AS k, count(*) AS users, " + ", ".join(f"round(avg({n}), 9) AS {n}" for n in METRICS) + " FROM scored GROUP BY k"


def sql(source: str, *ctes: str, split: str = parts()) -> str:
    *ctes, body = ctes
    return "WITH RECURSIVE " + ",\n".join([BASE[source], split, *ctes]) + "\n" + body


LISTS = [POPULAR, LIKED, ITEM_NEIGHBOURS.replace("neighbours AS (", "item_near AS ("), by_neighbours("collaborative", "item_near"),
         CONTENT_NEIGHBOURS.replace("neighbours AS (", "content_near AS ("), by_neighbours("content", "content_near")]


def fused(part: str) -> str:
    """The hybrid list by a part of every list's item (part: an expression of score, least, most, rank)."""
    return f"""candidates AS (
  SELECT 0.2 AS weight, user_id, item_id, rank, CAST(score AS DOUBLE) AS score FROM popular_lists
  UNION ALL SELECT 0.5, user_id, item_id, rank, score FROM collaborative
  UNION ALL SELECT 0.3, user_id, item_id, rank, score FROM content),
bounded AS (SELECT *, min(score) OVER (PARTITION BY weight, user_id) AS least, max(score) OVER (PARTITION BY weight, user_id) AS most FROM candidates),
summed AS (
  SELECT user_id, item_id, CAST(sum(CAST(floor({part} * CAST(weight AS DOUBLE) * 1000000000) AS BIGINT)) AS BIGINT) AS units, count(*) AS sources
  FROM bounded GROUP BY 1, 2),
hybrid AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY units DESC, item_id) AS rank, units / 1e9 AS score,
    CAST(sources AS INTEGER) AS sources FROM summed QUALIFY rank <= 10)"""


BY_SCORES = fused("CASE WHEN most > least THEN (score - least) / (most - least) ELSE 1.0::DOUBLE END")
BY_RANKS = fused("(1.0::DOUBLE / (rank + 60))")
SERVED = """offered AS (
  SELECT user_id, item_id, min(n * 1000 + rank) AS place
  FROM (SELECT 0 AS n, user_id, item_id, rank FROM collaborative UNION ALL SELECT 1, user_id, item_id, rank FROM content
        UNION ALL SELECT 2, user_id, item_id, rank FROM popular_lists) GROUP BY 1, 2),
served AS (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY place, item_id) AS rank, CAST(place // 1000 AS INTEGER) AS source
  FROM offered QUALIFY rank <= 10)"""
HISTORY = "history AS (SELECT user_id, count(DISTINCT item_id) AS n FROM train GROUP BY 1)"


def judged_alone(lists: str, name: str) -> str:
    """The user metrics of one list as a CTE of its own."""
    inner = user_metrics(lists)
    return f"{name} AS (WITH {inner} SELECT * FROM scored)"


def item_segment(name: str, test: str) -> str:
    """The user metrics of ``served`` with relevant items of one segment only."""
    inner = user_metrics("served").replace("judged j", "own_judged j").replace("JOIN relevant USING", "JOIN own USING")
    return f"""{name} AS (WITH own AS (SELECT * FROM relevant WHERE item_id {test} (SELECT item_id FROM train)),
own_judged AS (SELECT user_id, count(*) AS n_relevant FROM own GROUP BY user_id), {inner} SELECT * FROM scored)"""


_SPLIT = "SELECT user_id, item_id, timestamp_ms, rating, split FROM S"
_SUMMARY = ("SELECT split, count(*) AS interactions, min(timestamp_ms) AS first_ms, max(timestamp_ms) AS last_ms "
            "FROM S GROUP BY split")
_SCORED = "SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 9) AS score FROM {}"
_NEAR = "SELECT item_id, other_id, {}round(similarity, 9) AS similarity, CAST(rank AS INTEGER) AS rank FROM neighbours"
_LISTS = "SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, score FROM {}"

ORACLE = {
    "split_chronological": sql("events", _SPLIT),
    "lines_split_chronological": sql("lines", _SPLIT),
    "split_summary": sql("events", _SUMMARY),
    "lines_split_summary": sql("lines", _SUMMARY),
    "split_last_out": sql("events", """SELECT user_id, item_id, timestamp_ms,
  CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY timestamp_ms DESC, ordinal DESC) <= 2
    AND count(*) OVER (PARTITION BY user_id) > 2 THEN 'test' ELSE 'train' END AS split FROM I"""),
    "held_out_relevance": sql("events", "SELECT * FROM relevant"),
    "lines_held_out_relevance": sql("lines", "SELECT * FROM relevant"),
    "popularity_topk": sql("events", POPULAR, _LISTS.format("popular_lists")),
    "lines_popularity_topk": sql("lines", POPULAR, _LISTS.format("popular_lists")),
    "popularity_metrics": sql("events", POPULAR, user_metrics("popular_lists"), "SELECT " + MEANS),
    "popularity_user_metrics": sql("events", POPULAR, user_metrics("popular_lists"), USER_METRICS),
    "lines_popularity_metrics": sql("lines", POPULAR, user_metrics("popular_lists"), "SELECT " + MEANS),
}

for _prefix, _source in (("", "events"), ("lines_", "lines")):
    for _name, _near, _columns, _own in (("collaborative", ITEM_NEIGHBOURS, "common, ", "item_neighbours"),
                                         ("content", CONTENT_NEIGHBOURS, "", "content_neighbours")):
        _ctes = [LIKED, _near, by_neighbours(_name)]
        ORACLE |= {
            f"{_prefix}{_own}": sql(_source, LIKED, _near, _NEAR.format(_columns)),
            f"{_prefix}{_name}_topk": sql(_source, *_ctes, _SCORED.format(_name)),
            f"{_prefix}{_name}_metrics": sql(_source, *_ctes, user_metrics(_name), "SELECT " + MEANS),
        }

_MEAN_COLUMNS = MEANS.split(" FROM ")[0]
_NAMES = {"popular": "popular_lists", "collaborative": "collaborative", "content": "content", "hybrid": "hybrid"}
_EARLY = parts(1, 4)
for _prefix, _source in (("", "events"), ("lines_", "lines")):
    _fused = "SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 9) AS score, sources FROM hybrid"
    ORACLE |= {
        f"{_prefix}hybrid_topk": sql(_source, *LISTS, BY_SCORES, _fused),
        f"{_prefix}model_comparison": sql(
            _source, *LISTS, BY_SCORES, *[judged_alone(t, f"of_{n}") for n, t in _NAMES.items()],
            "\nUNION ALL ".join(f"SELECT '{n}' AS model, {_MEAN_COLUMNS} FROM of_{n} GROUP BY k" for n in _NAMES)),
    }
ORACLE |= {
    "hybrid_by_ranks_topk": sql("events", *LISTS, BY_RANKS, _fused),
    "lines_served_topk": sql("lines", *LISTS, SERVED, "SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, source FROM served", split=_EARLY),
    "lines_cold_user_metrics": sql("lines", *LISTS, SERVED, HISTORY, judged_alone("served", "of_served"), f"""SELECT segment, {_MEAN_COLUMNS}
FROM (SELECT s.*, CASE WHEN n IS NULL THEN 'cold' WHEN n < 5 THEN 'sparse' ELSE 'active' END AS segment FROM of_served s LEFT JOIN history USING (user_id))
GROUP BY segment, k""", split=_EARLY),
    "lines_cold_item_metrics": sql("lines", *LISTS, SERVED, item_segment("of_cold", "NOT IN"), item_segment("of_known", "IN"),
                                   "\nUNION ALL ".join(f"SELECT '{n}' AS segment, {_MEAN_COLUMNS} FROM of_{n} GROUP BY k" for n in ("cold", "known")),
                                   split=_EARLY),
}
