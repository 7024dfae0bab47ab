"""Vectors, clusters, draws, pools, negatives, examples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import round6
from ..operators import clustering as K
from ..operators import sampling as SA
from ..operators import vectors as V
from ..session import cut_lineage
from . import binding as b
from .binding import r6, with_ctes
from .registry import query

DIM = 64
K_DRAWS = SA.SAMPLES_PER_BASKET


def _long(df, vec, *keys):
    return df.select(*keys, F.posexplode(vec).alias("dim", "value")).withColumn("value", round6(F.col("value")))


def _vectors(spark, folder, index):
    return b.item_vectors(spark, folder, index)


_POOLED = """cells as (select basket, dim, sum(qty * v) / sum(qty) as a, max(v) as m from (
      select basket, qty, unnest(vec) as v, generate_subscripts(vec, 1) - 1 as dim
      from lines join item_vectors using (item_idx)) group by all)"""


@query("basket_vectors", with_ctes("lines item_vectors", f"""
    select basket, dim::int as dim, {r6('a / sqrt(sum(a * a) over (partition by basket))')} as value from cells""", _POOLED))
def basket_vectors(spark, folder):
    index = b.items(spark, folder)
    return _long(V.basket_vectors(cut_lineage(b.lines(spark, folder, index)), _vectors(spark, folder, index), DIM), "vec", "basket")


@query("mean_max_pool", with_ctes("lines item_vectors", f"""
    select basket, dim::int as dim, {r6('a')} as mean, {r6('m')} as top from cells""", _POOLED))
def mean_max_pool(spark, folder):
    index = b.items(spark, folder)
    pooled = V.mean_max_pool(cut_lineage(b.lines(spark, folder, index)), _vectors(spark, folder, index), DIM)
    return pooled.select("basket", F.posexplode(F.arrays_zip("pool_mean", "pool_max")).alias("dim", "z")).select(
        "basket", "dim", round6(F.col("z.pool_mean")).alias("mean"), round6(F.col("z.pool_max")).alias("top"))


def _points(spark, folder):
    return b.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")


_CENTRES = """pts as (select vec_id as id, label, embedding::double[] as vec from embeddings),
    means as (select label, dim, avg(v) as a from (
      select label, unnest(vec) as v, generate_subscripts(vec, 1) as dim from pts) group by all),
    centres as (select label as cluster, list(a / n order by dim) as centroid
      from (select *, sqrt(sum(a * a) over (partition by label)) as n from means) group by label),
    near as (select id, vec, arg_min(cluster, (d, cluster)) as cluster, min(d) as distance
      from (select id, vec, cluster, list_distance(vec, centroid) as d from pts cross join centres) group by all)"""


@query("nearest_centroid", with_ctes("", f"select id, cluster, {r6('distance')} as distance from near", _CENTRES))
def nearest_centroid(spark, folder):
    points = _points(spark, folder)
    return K.nearest_centroid(points, K.label_centroids(points, "label", DIM)).select(
        "id", "cluster", round6(F.col("distance")).alias("distance"))


@query("kmeans_step", with_ctes("", f"""
    select cluster, count(*) over (partition by cluster, dim) as size, (dim - 1)::int as dim, {r6('avg(v)')} as value
    from (select cluster, unnest(vec) as v, generate_subscripts(vec, 1) as dim from near) group by cluster, dim""".replace(
        "count(*) over (partition by cluster, dim)", "count(*)"), _CENTRES))
def kmeans_step(spark, folder):
    points = _points(spark, folder)
    step = K.kmeans_step(points, K.label_centroids(points, "label", DIM), DIM)
    return _long(step, "centroid", "cluster", "size")


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    """Archetypes of the basket vectors."""
    index = b.items(spark, folder)
    vectors = V.basket_vectors(cut_lineage(b.lines(spark, folder, index)), _vectors(spark, folder, index), DIM)
    return K.kmeans_fit(vectors, K.ARCHETYPES, b.SEED, ident="basket").table(spark)


_STEPS = """stepped as (select cluster, list(a order by dim) as centroid from (
      select cluster, dim, avg(v) as a from (
        select cluster, unnest(vec) as v, generate_subscripts(vec, 1) as dim from near) group by all) group by cluster),
    closer as (select id, vec, arg_min(cluster, (d, cluster)) as cluster
      from (select id, vec, cluster, list_distance(vec, centroid) as d from pts cross join stepped) group by all)"""


@query("kmeans_two_steps", with_ctes("", f"""
    select cluster, count(*) as size, (dim - 1)::int as dim, {r6('avg(v)')} as value
    from (select cluster, unnest(vec) as v, generate_subscripts(vec, 1) as dim from closer) group by cluster, dim""", _CENTRES + ", " + _STEPS))
def kmeans_two_steps(spark, folder):
    """The first two steps of the fit from given centres."""
    points = _points(spark, folder)
    return _long(K.lloyd(points, K.label_centroids(points, "label", DIM), DIM, 2), "centroid", "cluster", "size")


@query("target_distribution", with_ctes("lines", f"""
    select basket, item_idx, {r6('qty / sum(qty) over (partition by basket)')} as weight from lines"""))
def target_distribution(spark, folder):
    return SA.target_distribution(b.lines(spark, folder)).withColumn("weight", round6(F.col("weight")))


@query("expand_multiset", with_ctes("lines", """
    select basket, item_idx, unnest(generate_series(hi - qty, hi - 1))::bigint as position
    from (select *, (sum(qty) over (partition by basket order by item_idx))::bigint as hi from lines)"""))
def expand_multiset(spark, folder):
    return SA.expand_multiset(b.lines(spark, folder))


_DRAWN = f"""spans as (select *, (sum(qty) over (partition by basket order by item_idx))::bigint as hi from lines),
    draws as (select basket, draw, {b.u32_sql(f"'{b.SEED}'", 'basket', 'draw')} % total as pos, total
      from (select basket, sum(qty)::bigint as total from lines group by basket)
      cross join (select unnest(range({K_DRAWS}))::int as draw)),
    removed as (select basket, draw, item_idx as removed, total from draws join spans using (basket)
      where pos >= hi - qty and pos < hi),
    asked as (select r.basket, draw, removed, bucket, {b.u32_sql(f"'{b.SEED}'", "'neg'", 'r.basket', 'draw')} as h
      from removed r join items i on i.item_idx = r.removed)"""


def _removed(spark, folder, lines):
    return SA.leave_one_out(lines, K_DRAWS, b.SEED)


@query("leave_one_out", with_ctes("lines items", """
    select r.basket, draw, removed, item_idx, qty - (item_idx = removed)::int as qty
    from removed r join lines l using (basket) where qty - (item_idx = removed)::int > 0""", _DRAWN))
def leave_one_out(spark, folder):
    return SA.partial_draws(b.lines(spark, folder), K_DRAWS, b.SEED)


@query("one_hot_target", with_ctes("lines items", "select basket, draw, removed as item_idx, 1.0::double as weight from removed", _DRAWN))
def one_hot_target(spark, folder):
    return SA.one_hot_target(_removed(spark, folder, b.lines(spark, folder)))


_POOL = """pool as (select k.barred, facet_key, item_idx, bucket from segment_keys k join items i on i.facet is distinct from k.barred)"""


@query("candidate_pool", with_ctes("played segment_keys items", """
    select facet_key, item_idx, bucket, row_number() over (partition by facet_key order by item_idx) - 1 as rank_all,
      row_number() over (partition by facet_key, bucket order by item_idx) - 1 as rank_bucket from pool""", _POOL))
def candidate_pool(spark, folder):
    return SA.pools(b.played(spark, folder), b.items(spark, folder))


@query("candidate_pool_bucket", with_ctes("played segment_keys items", """
    select facet_key, bucket, count(*) as pool_size from pool group by all
    union all select facet_key, -1, count(*) from pool group by all""", _POOL))
def candidate_pool_bucket(spark, folder):
    return SA.pool_sizes(SA.pools(b.played(spark, folder), b.items(spark, folder)))


@query("candidate_open_counts", with_ctes("played lines segment_keys items", """
    select p.basket, p.facet_key, s.n as pool_size, s.n - coalesce(o.own, 0) as open_size
    from played p join (select facet_key, count(*) as n from pool group by all) s using (facet_key)
    left join (select basket, count(*) as own from lines join played using (basket) join pool using (facet_key, item_idx)
      group by basket) o using (basket)""", _POOL))
def candidate_open_counts(spark, folder):
    index = b.items(spark, folder)
    heads = b.played(spark, folder)
    return SA.open_counts(b.lines(spark, folder, index), heads, SA.pools(heads, index))


_OPEN = _DRAWN + ", " + _POOL + """,
    open_all as (select p.basket, list(pool.item_idx order by pool.item_idx) as ids from played p join pool using (facet_key)
      anti join lines l on l.basket = p.basket and l.item_idx = pool.item_idx group by p.basket),
    open_bucket as (select a.basket, a.bucket, list(pool.item_idx order by pool.item_idx) as ids
      from (select distinct basket, bucket from asked) a join played p using (basket)
      join pool on pool.facet_key = p.facet_key and pool.bucket = a.bucket
      anti join lines l on l.basket = a.basket and l.item_idx = pool.item_idx group by all),
    random_neg as (select basket, draw, removed, bucket, ids[(h % len(ids) + 1)::bigint] as negative
      from asked join open_all using (basket)),
    bucket_neg as (select a.basket, a.draw, a.removed, a.bucket,
        coalesce(o.ids[(a.h % len(o.ids) + 1)::bigint], r.negative) as negative
      from asked a join random_neg r using (basket, draw) left join open_bucket o on o.basket = a.basket and o.bucket = a.bucket)"""

_PEERS = _OPEN + f""",
    ranked as (select facet_key, basket, row_number() over (partition by facet_key order by h, basket) - 1 as peer_rank,
        count(*) over (partition by facet_key) as n
      from (select *, {b.u32_sql(f"'{b.SEED}'", "'peer'", 'basket')} as h from played)),
    tries as (select a.basket, a.draw, a.bucket, t as attempt, r.facet_key,
        ({b.u32_sql(f"'{b.SEED}'", "'start'", 'a.basket', 'a.draw')} % r.n + t) % r.n as peer_rank
      from asked a join ranked r using (basket) cross join (select unnest(range(12)) as t)
      where r.n >= 2 and t < r.n),
    peer_found as (select t.basket, t.draw, t.attempt, r.basket as peer, l.item_idx from tries t
      join ranked r using (facet_key, peer_rank) join lines l on l.basket = r.basket
      join items i on i.item_idx = l.item_idx and i.bucket = t.bucket
      anti join lines own on own.basket = t.basket and own.item_idx = l.item_idx),
    swap_neg as (select b.basket, b.draw, b.removed, b.bucket, coalesce(s.item, b.negative) as negative
      from bucket_neg b left join (select basket, draw, arg_min(item_idx, (attempt, h, item_idx)) as item
        from (select *, {b.u32_sql(f"'{b.SEED}'", "'swap'", 'basket', 'draw', 'item_idx')} as h from peer_found)
        group by basket, draw) s using (basket, draw))"""

_NEEDS = "played lines segment_keys items"


def _negatives(spark, folder, phase):
    index, lines, heads = b.stored(spark, folder)
    return SA.negatives(None, lines, heads, index, phase, b.SEED, index.count(), k=K_DRAWS)


@query("negatives_random", with_ctes(_NEEDS, "select * from random_neg", _OPEN))
def negatives_random(spark, folder):
    return _negatives(spark, folder, "random")


@query("negatives_bucket", with_ctes(_NEEDS, "select * from bucket_neg", _OPEN))
def negatives_bucket(spark, folder):
    return _negatives(spark, folder, "bucket")


@query("negatives_swap", with_ctes(_NEEDS, "select * from swap_neg", _PEERS))
def negatives_swap(spark, folder):
    return _negatives(spark, folder, "swap")


@query("peer_items", with_ctes(_NEEDS, "select * from peer_found", _PEERS))
def peer_items(spark, folder):
    index, lines, heads = b.stored(spark, folder)
    return SA.peer_items(None, lines, heads, index, b.SEED, k=K_DRAWS)


@query("evaluator_examples", with_ctes(_NEEDS, """
    select basket, draw, removed, removed as candidate, 1.0::double as label from swap_neg
    union all select basket, draw, removed, negative, 0.0::double from swap_neg""", _PEERS))
def evaluator_examples(spark, folder):
    return SA.evaluator_examples(_negatives(spark, folder, "swap"))


_HOT = ", ".join(f"(barred is distinct from '{f}')::int as {f.lower()}" for f in b.FACETS)


@query("proposal_examples", with_ctes("played lines items", f"""
    select basket, draw, removed, item_idx, qty - (item_idx = removed)::int as partial_qty,
      {r6('qty / total')} as target, {_HOT} from removed join lines using (basket) join played using (basket)""", _DRAWN))
def proposal_examples(spark, folder):
    rows = SA.proposal_examples(b.lines(spark, folder), b.played(spark, folder), b.FACETS, K_DRAWS, b.SEED)
    hot = [F.col("facet_hot")[i].alias(f.lower()) for i, f in enumerate(b.FACETS)]
    return rows.select("basket", "draw", "removed", "item_idx", "partial_qty", round6(F.col("target")).alias("target"), *hot)


@query("pad_batches", with_ctes("lines items", """
    select basket, draw, removed, total, batch::bigint as batch, w::int as width,
      array_to_string(list_resize(ids, w, 0), ' ') as ids
    from (select *, max(len(ids)) over (partition by batch) as w from (
      select r.basket, draw, removed, total, coalesce(list(item_idx order by item_idx) filter (item_idx is not null), [0]) as ids,
        floor((row_number() over (order by r.basket, draw) - 1) / 64) as batch
      from removed r left join (select basket as bk, item_idx, hi, qty, unnest(range(qty)) as copy from spans) c
        on c.bk = r.basket and not (c.item_idx = r.removed and c.copy = 0)
      group by r.basket, draw, removed, total))""", _DRAWN))
def pad_batches(spark, folder):
    return SA.draw_batches(b.lines(spark, folder), 64, K_DRAWS, b.SEED).withColumn("ids", F.array_join("ids", " "))
