"""Driver queries of the recommenders and their evaluation, over both record views."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import clean
from feedloom.plans.queries import events_interactions, lines_interactions, present
from feedloom.operators.index import encode_interactions, fit_encoders, invert_index
from feedloom.recommend import coldstart, content, factorize, hybrid, item_item, popularity, ranking, split
from feedloom.session import materialize
from feedloom.sources import fixtures as fx

KS = (5, 10)
K = max(KS)


def parted(spark, d, source, **shares):
    """Cleaned interactions with their part, written once; the part follows from the time where it is read."""
    clean = (events_interactions if source == "events" else lines_interactions)(spark, d, False)
    clean = materialize(clean.select("user_id", "item_id", "timestamp_ms", "rating", "ordinal"), f"{source}-interactions")
    return split.chronological_split(clean, **shares)


def training(parts):
    return parts.where(F.col("split") == split.TRAIN)


def rounded(df, digits=9):
    """Doubles at a precision that the order of additions does not reach."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema.fields])


def q_split(source):
    def run(spark, d):
        return parted(spark, d, source).select("user_id", "item_id", "timestamp_ms", "rating", "split")
    return run


def q_split_summary(source):
    def run(spark, d):
        return parted(spark, d, source).groupBy("split").agg(
            F.count(F.lit(1)).alias("interactions"), F.min("timestamp_ms").alias("first_ms"), F.max("timestamp_ms").alias("last_ms"))
    return run


def q_split_last_out(spark, d):
    return present(split.leave_last_out(events_interactions(spark, d, False), 2).select("user_id", "item_id", "timestamp_ms", "ordinal", "split"))


def q_relevance(source):
    def run(spark, d):
        return split.held_out_relevance(parted(spark, d, source))
    return run


def _popular(spark, d, source):
    parts = parted(spark, d, source)
    relevant = materialize(split.held_out_relevance(parts), "relevant")
    return popularity.recommend_popular(training(parts), relevant, K), relevant


def q_popularity(source):
    def run(spark, d):
        return _popular(spark, d, source)[0]
    return run


def q_popularity_metrics(source):
    def run(spark, d):
        return rounded(ranking.ranking_metrics(*_popular(spark, d, source), KS))
    return run


def q_popularity_user_metrics(spark, d):
    return rounded(ranking.user_metrics(*_popular(spark, d, "events"), KS))


def catalogue(spark, d, parts):
    """Items of the whole view: also those that nobody met in training."""
    return materialize(clean.clean_items(fx.raw_items(spark, d), parts, sort=False), "items")


def q_item_neighbours(source):
    def run(spark, d):
        near = item_item.item_neighbours(item_item.liked(training(parted(spark, d, source))))
        return rounded(near.select("item_id", "other_id", "common", "similarity", "rank"))
    return run


def _collaborative(spark, d, source):
    parts = parted(spark, d, source)
    relevant = materialize(split.held_out_relevance(parts), "relevant")
    return item_item.recommend_collaborative(training(parts), relevant, K), relevant


def q_collaborative(source):
    def run(spark, d):
        return rounded(_collaborative(spark, d, source)[0])
    return run


def q_collaborative_metrics(source):
    def run(spark, d):
        return rounded(ranking.ranking_metrics(*_collaborative(spark, d, source), KS))
    return run


def q_content_neighbours(source):
    def run(spark, d):
        near = content.content_neighbours(catalogue(spark, d, parted(spark, d, source)))
        return rounded(near.select("item_id", "other_id", "similarity", "rank"))
    return run


def _by_content(spark, d, source):
    parts = parted(spark, d, source)
    relevant = materialize(split.held_out_relevance(parts), "relevant")
    return content.recommend_by_content(training(parts), catalogue(spark, d, parts), relevant, K), relevant


def q_content(source):
    def run(spark, d):
        return rounded(_by_content(spark, d, source)[0])
    return run


def q_content_metrics(source):
    def run(spark, d):
        return rounded(ranking.ranking_metrics(*_by_content(spark, d, source), KS))
    return run


WEIGHTS = {"popular": 0.2, "collaborative": 0.5, "content": 0.3}
EARLY = {"validation": 0.4, "test": 0.5}  # so little to train on that users and items of the test part are unknown


def _lists(spark, d, source, **shares):
    """Lists of three recommenders for the users with relevant items, each written once."""
    parts = parted(spark, d, source, **shares)
    train, relevant = training(parts), materialize(split.held_out_relevance(parts), "relevant")
    lists = {"popular": popularity.recommend_popular(train, relevant, K),
             "collaborative": item_item.recommend_collaborative(train, relevant, K),
             "content": content.recommend_by_content(train, catalogue(spark, d, parts), relevant, K)}
    return train, relevant, {name: materialize(df, name) for name, df in lists.items()}


def q_hybrid(source, method):
    def run(spark, d):
        _, _, lists = _lists(spark, d, source)
        return rounded(hybrid.fuse(lists, WEIGHTS, K, method))
    return run


def q_model_comparison(source):
    def run(spark, d):
        _, relevant, lists = _lists(spark, d, source)
        lists["hybrid"] = hybrid.fuse(lists, WEIGHTS, K)
        found = None
        for name, df in lists.items():
            part = ranking.ranking_metrics(df, relevant, KS).select(F.lit(name).alias("model"), "*")
            found = part if found is None else found.unionByName(part)
        return rounded(found)
    return run


def _served(spark, d):
    """Personal lists first, popular items for the rest, from an early cut of the larger view."""
    train, relevant, lists = _lists(spark, d, "lines", **EARLY)
    served = coldstart.fill_up([lists["collaborative"], lists["content"], lists["popular"]], K)
    return train, relevant, materialize(served, "served")


def q_served(spark, d):
    return _served(spark, d)[2]


def q_cold_users(spark, d):
    train, relevant, served = _served(spark, d)
    segments = coldstart.user_segments(relevant, fit_encoders(train)[0], train)
    return rounded(coldstart.metrics_by_user_segment(served, relevant, segments, KS))


def q_cold_items(spark, d):
    train, relevant, served = _served(spark, d)
    segments = coldstart.item_segments(relevant, fit_encoders(train)[1])
    return rounded(coldstart.metrics_by_item_segment(served, relevant, segments, KS))


def _factorised(spark, d, source):
    parts = parted(spark, d, source)
    users, items = (materialize(m, "mapping") for m in fit_encoders(training(parts)))
    encoded = encode_interactions(training(parts).select("user_id", "item_id", "rating"), users, items)
    return parts, users, items, factorize.deal(factorize.known_ratings(encoded))


def _factorised_lists(spark, d, source):
    parts, users, items, ratings = _factorised(spark, d, source)
    model = factorize.factorise(ratings)
    relevant = materialize(split.held_out_relevance(parts), "relevant")
    asked = encode_interactions(relevant, users, items).where("user_idx >= 0")
    best = factorize.recommend_factorised(model, ratings.ratings, asked, K)
    named = invert_index(invert_index(best, users, "user_idx", "user_id"), items, "item_idx", "item_id")
    return rounded(named.select("user_id", "item_id", "rank", "score")), relevant


def q_factorised_topk(source):
    def run(spark, d):
        return _factorised_lists(spark, d, source)[0]
    return run


def q_factorised_metrics(source):
    def run(spark, d):
        lists, relevant = _factorised_lists(spark, d, source)
        return rounded(ranking.ranking_metrics(materialize(lists, "factorised"), relevant, KS))
    return run


def q_factorised_loss(spark, d):
    """rmse and objective after every iteration."""
    ratings = _factorised(spark, d, "lines")[3]
    rows = []

    def watch(model):
        rows.append(materialize(factorize.loss(ratings, model).select(F.lit(len(rows) + 1).alias("iteration"), "*"), "loss"))

    factorize.factorise(ratings, watch=watch)
    found = rows[0]
    for part in rows[1:]:
        found = found.unionByName(part)
    return rounded(found, 6)


QUERIES = {
    "split_chronological": q_split("events"),
    "lines_split_chronological": q_split("lines"),
    "split_summary": q_split_summary("events"),
    "lines_split_summary": q_split_summary("lines"),
    "split_last_out": q_split_last_out,
    "held_out_relevance": q_relevance("events"),
    "lines_held_out_relevance": q_relevance("lines"),
    "popularity_topk": q_popularity("events"),
    "lines_popularity_topk": q_popularity("lines"),
    "popularity_metrics": q_popularity_metrics("events"),
    "popularity_user_metrics": q_popularity_user_metrics,
    "lines_popularity_metrics": q_popularity_metrics("lines"),
    "item_neighbours": q_item_neighbours("events"),
    "lines_item_neighbours": q_item_neighbours("lines"),
    "collaborative_topk": q_collaborative("events"),
    "lines_collaborative_topk": q_collaborative("lines"),
    "collaborative_metrics": q_collaborative_metrics("events"),
    "lines_collaborative_metrics": q_collaborative_metrics("lines"),
    "content_neighbours": q_content_neighbours("events"),
    "lines_content_neighbours": q_content_neighbours("lines"),
    "content_topk": q_content("events"),
    "lines_content_topk": q_content("lines"),
    "content_metrics": q_content_metrics("events"),
    "lines_content_metrics": q_content_metrics("lines"),
    "hybrid_topk": q_hybrid("events", "scores"),
    "lines_hybrid_topk": q_hybrid("lines", "scores"),
    "hybrid_by_ranks_topk": q_hybrid("events", "ranks"),
    "model_comparison": q_model_comparison("events"),
    "lines_model_comparison": q_model_comparison("lines"),
    "lines_served_topk": q_served,
    "lines_cold_user_metrics": q_cold_users,
    "lines_cold_item_metrics": q_cold_items,
    "factorised_topk": q_factorised_topk("events"),
    "lines_factorised_topk": q_factorised_topk("lines"),
    "lines_factorised_metrics": q_factorised_metrics("lines"),
    "lines_factorised_loss": q_factorised_loss,
}
