"""Held-out baskets judged against the training ones; proposals and blended scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.facets import facet_key
from ..functions.vectors import round6
from ..operators import baskets as B
from ..operators import clustering as K
from ..operators import evaluation as E
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import sampling as SA
from ..operators import scoring as SC
from ..operators import splits as S
from ..operators import vectors as V
from ..session import cut_lineage
from . import binding as b
from .binding import r6, with_ctes
from .examples import _CENTRES, _DRAWN, _POOLED, DIM, K_DRAWS, _points
from .metrics import _AUC, _LOGITS, _SCORED, _logits, _scored
from .registry import query


def _sets(spark, folder):
    """Index, lines, headers, and the lines of held-out and training baskets."""
    index, lines, heads = b.stored(spark, folder)
    failed = B.legality_reasons(lines, heads, index).select("basket").distinct()
    split = cut_lineage(S.heldout_split(heads.join(failed, "basket", "left_anti"), seed=b.SEED).select("basket", "heldout"))
    sample = lines.join(split.filter("heldout"), "basket", "left_semi")
    train = lines.join(split.filter("not heldout"), "basket", "left_semi")
    return index, lines, heads, sample, train


_SETS = """sample as (select l.* from lines l join split s using (basket) where heldout),
    train as (select l.* from lines l join split s using (basket) where not heldout)"""


@query("legality_rate", with_ctes("lines items played reasons", f"""
    select segment, count(*) as baskets, {r6('avg(ok::int)')} as legal_rate,
      {r6('avg((ok and n = 5 and clean)::int)')} as exact_rate from (
      select p.segment, p.basket not in (select basket from reasons) as ok,
        count(distinct facet) as n, bool_and(facet <> p.barred) as clean
      from played p left join lines using (basket) left join items using (item_idx) group by p.segment, p.basket) group by segment"""))
def legality_rate(spark, folder):
    index, lines, heads = b.stored(spark, folder)
    used = lines.join(index.select("item_idx", F.col("version").alias("facet")), "item_idx")
    out = E.legality_rate(heads, B.legality_reasons(lines, heads, index), used, ["segment"])
    return out.select("segment", "baskets", round6(F.col("legal_rate")).alias("legal_rate"), round6(F.col("exact_rate")).alias("exact_rate"))


def _with(lines, index, *cols):
    return lines.join(index.select("item_idx", *cols), "item_idx")


_KL = """select sum(p * ln(p / q)) as kl from (
      select (coalesce(s, 0) + 0.5::double) / (sum(coalesce(s, 0)) over () + 6.0::double) as p,
        (coalesce(c, 0) + 0.5::double) / (sum(coalesce(c, 0)) over () + 6.0::double) as q
      from (select unnest(range(12)) as bucket)
      left join (select bucket, sum(qty) as s from sample join items using (item_idx) group by bucket) using (bucket)
      left join (select bucket, sum(qty) as c from train join items using (item_idx) group by bucket) using (bucket))"""


@query("curve_kl", with_ctes("lines split items", f"select {r6('kl')} as kl from ({_KL})", _SETS))
def curve_kl(spark, folder):
    index, _, _, sample, train = _sets(spark, folder)
    return E.curve_kl(_with(sample, index, "bucket"), _with(train, index, "bucket"), 12).select(round6(F.col("kl")).alias("kl"))


@query("type_chi2", with_ctes("lines split items", f"""
    select {r6('sum((s - e) ** 2 / e)')} as chi2, count(*) - 1 as dof from (
      select coalesce(s, 0) as s, sum(coalesce(s, 0)) over () * c / sum(c) over () as e
      from (select facet, sum(qty) as c from train join items using (item_idx) group by facet)
      left join (select facet, sum(qty) as s from sample join items using (item_idx) group by facet) using (facet))""", _SETS))
def type_chi2(spark, folder):
    index, _, _, sample, train = _sets(spark, folder)
    facet = F.col("version").alias("facet")
    return E.type_chi2(_with(sample, index, facet), _with(train, index, facet)).withColumn("chi2", round6(F.col("chi2")))


# Upper 5 % point of chi-square with five degrees: six types.
_CRITICAL = 11.070497693516351


@query("type_mix", with_ctes("lines split items", f"""
    select {r6('chi2')} as chi2, dof, chi2 < {_CRITICAL} as passes from (select sum((s - e) ** 2 / e) as chi2, count(*) - 1 as dof from (
      select coalesce(s, 0) as s, sum(coalesce(s, 0)) over () * c / sum(c) over () as e
      from (select facet, sum(qty) as c from train join items using (item_idx) group by facet)
      left join (select facet, sum(qty) as s from sample join items using (item_idx) group by facet) using (facet)))""", _SETS))
def type_mix(spark, folder):
    index, _, _, sample, train = _sets(spark, folder)
    facet = F.col("version").alias("facet")
    return E.type_mix_passes(_with(sample, index, facet), _with(train, index, facet)).withColumn("chi2", round6(F.col("chi2")))


_SHARE = "sum(case when flag then qty else 0 end) / sum(qty)"


@query("flag_share", with_ctes("lines split items", f"""
    select {r6('a')} as share, {r6('c')} as corpus_share, {r6('abs(a - c) * 100')} as distance_pp from (
      select (select {_SHARE} from sample join items using (item_idx)) as a,
        (select {_SHARE} from train join items using (item_idx)) as c)""", _SETS))
def flag_share(spark, folder):
    index, _, _, sample, train = _sets(spark, folder)
    out = E.flag_share(_with(sample, index, "flag"), _with(train, index, "flag"))
    return out.select(*[round6(F.col(c)).alias(c) for c in out.columns])


_REFERENCES = """select l.basket, l.item_idx, count(m.item_idx) as others
        from lines l join items i using (item_idx)
        left join (select basket, item_idx, unnest(classes) as class from lines join items using (item_idx)) m
          on m.basket = l.basket and m.class = i.classes[1] and m.item_idx <> l.item_idx
        group by all"""


@query("reference_compliance", with_ctes("lines items", f"""
    select cases, compliant, {r6('compliant / cases')} as rate from (
      select count(*) as cases, count(*) filter (others >= 1) as compliant from ({_REFERENCES}))"""))
def reference_compliance(spark, folder):
    index, lines, _ = b.stored(spark, folder)
    texts = index.withColumn("text", F.concat(F.lit("Your "), F.col("classes")[0], F.lit(" characters get +1 {S}.")))
    return E.reference_compliance(lines, texts).withColumn("rate", round6(F.col("rate")))


@query("base_compliance", with_ctes("lines items item_texts", f"""
    , names as (select string_agg(distinct regexp_escape(name), '|') as p from items),
    named as (select item_idx, unnest(list_distinct(regexp_extract_all(text, p))) as ref from item_texts, names),
    cases as (select l.basket, l.item_idx, count(m.item_idx) as others
      from lines l join named r using (item_idx) join items i using (item_idx)
      left join (select basket, item_idx, name from lines join items using (item_idx)) m
        on m.basket = l.basket and m.name = r.ref and m.item_idx <> l.item_idx
      where r.ref <> i.name group by l.basket, l.item_idx, r.ref)
    select cases, compliant, {r6('compliant / cases')} as rate from (
      select count(*) as cases, count(*) filter (others >= 1) as compliant from cases)"""))
def base_compliance(spark, folder):
    """Baskets that hold an item whose text names a base item, and those among them that hold the base too."""
    index, lines, _ = b.stored(spark, folder)
    return E.base_compliance(lines, index, b.item_texts(spark, folder, index)).withColumn("rate", round6(F.col("rate")))


_COVERED = """select basket, bool_and(s >= d) as covered from (
      select basket, sum(s) over w as s, sum(d) over w as d from (
        select basket, bucket, sum(case when facet = 'LARGE' then qty else 0 end) as s,
          sum(case when facet = 'SMALL' then qty else 0 end) as d
        from lines join items using (item_idx) group by all)
      window w as (partition by basket order by bucket desc)) group by basket"""


@query("supply_demand", with_ctes("lines items", _COVERED))
def supply_demand(spark, folder):
    index, lines, _ = b.stored(spark, folder)
    rows = _with(lines, index, "bucket", F.col("version").alias("facet"))
    return E.supply_demand(rows, F.col("facet") == "LARGE", F.col("facet") == "SMALL")


@query("archetype_distance", with_ctes("lines item_vectors", f"""
    , vectors as (select basket, list(a / n order by dim) as vec from (
        select basket, dim, a, sqrt(sum(a * a) over (partition by basket)) as n from cells) group by basket)
    select {r6('avg(d)')} as distance from (
      select basket, min(list_distance(vec, centroid)) as d from vectors cross join centres group by basket)""", _POOLED + ", " + _CENTRES))
def archetype_distance(spark, folder):
    index = b.items(spark, folder)
    vectors = V.basket_vectors(cut_lineage(b.lines(spark, folder, index)), b.item_vectors(spark, folder, index), DIM)
    centres = K.label_centroids(_points(spark, folder), "label", DIM)
    return K.nearest_centroid(vectors, centres).agg(round6(F.avg("distance")).alias("distance"))


@query("coverage", with_ctes("lines split items", f"""
    select used, legal, {r6('used / legal')} as coverage from (
      select (select count(distinct item_idx) from sample join items using (item_idx) where legality = 'legal') as used,
        (select count(*) from items where legality = 'legal') as legal)""", _SETS))
def coverage(spark, folder):
    index, _, _, sample, _ = _sets(spark, folder)
    return E.coverage(sample, index).withColumn("coverage", round6(F.col("coverage")))


@query("verbatim_rate", with_ctes("lines split items", f"""
    , kinds as (select basket, heldout, string_agg(facet || n, ',' order by facet) as digest from (
        select basket, facet, heldout, count(*) as n from lines join split using (basket) join items using (item_idx) group by all)
      group by all)
    select count(*) as baskets, count(*) filter (hit) as verbatim, {r6('avg(hit::int)')} as rate from (
      select digest in (select digest from kinds where not heldout) as hit from kinds where heldout)""", _SETS))
def verbatim_rate(spark, folder):
    """A basket as a multiset of facets, so that repeats occur."""
    index, _, _, sample, train = _sets(spark, folder)

    def kinds(lines):
        return _with(lines, index, F.col("version").alias("facet")).groupBy("basket", "facet").agg(F.count("*").alias("qty"))

    return E.verbatim_rate(kinds(sample), kinds(train), "facet").withColumn("rate", round6(F.col("rate")))


@query("underplayed_share", with_ctes("lines split", f"""
    , f as (select item_idx, sum(qty) / (select sum(qty) from train) as p from train group by item_idx),
    bar as (select quantile_cont(p, 0.1) as bar from f)
    select {r6('avg(s)')} as underplayed from (
      select basket, sum(case when coalesce(p, 0) < bar then qty else 0 end) / sum(qty) as s
      from sample left join f using (item_idx) cross join bar group by basket)""", _SETS))
def underplayed_share(spark, folder):
    _, _, _, sample, train = _sets(spark, folder)
    return E.underplayed_share(sample, train).select(round6(F.col("underplayed")).alias("underplayed"))


_JACCARD = f"""hashed as (select item_idx, f, {b.u32_sql(f"'{E.JACCARD_SEED}'", 'f', 'item_idx')} as h
      from (select distinct item_idx from lines) cross join (select unnest(range({E.JACCARD_FUNCTIONS})) as f)),
    minima as (select basket, f, min(h) as h from lines join hashed using (item_idx) group by basket, f),
    met as (select f, sum(c * (c - 1)) / (sum(c) * (sum(c) - 1)) as share, sum(c)::bigint as n
      from (select f, h, count(*) as c from minima group by f, h) group by f),
    jac as (select max(n) as baskets, 1 - avg(share) as diversity,
      stddev_samp(share) / sqrt({E.JACCARD_FUNCTIONS}) as std_error from met)"""


@query("jaccard_diversity", with_ctes(
    "lines", f"select baskets, {r6('diversity')} as diversity, {r6('std_error')} as std_error from jac", _JACCARD))
def jaccard_diversity(spark, folder):
    out = E.jaccard_diversity(cut_lineage(b.lines(spark, folder)))
    return out.select("baskets", *[round6(F.col(c)).alias(c) for c in ("diversity", "std_error")])


_GATE_ROWS = ", ".join(
    f"('{m}', '{k}', {'null' if lo is None else lo}::double, {'null' if hi is None else hi}::double)" for m, k, lo, hi in E.GATES)


@query("quality_gates", with_ctes("lines played reasons split items item_vectors", f"""
    , vectors as (select basket, list(a / n order by dim) as vec from (
        select basket, dim, a, sqrt(sum(a * a) over (partition by basket)) as n from cells) group by basket),
    m as (select 'legality_rate' as metric, (select avg((basket not in (select basket from reasons))::int) from played) as value
      union all select 'evaluator_auroc', (select {_AUC} from scored p join scored n on p.label > 0.5 and n.label <= 0.5)
      union all select 'held_out_nll', (select avg(ce) from ce)
      union all select 'diversity', (select diversity from jac)
      union all select 'curve_kl', ({_KL})
      union all select 'flag_distance_pp', 100 * abs((select {_SHARE} from sample join items using (item_idx)) - (select {_SHARE} from train join items using (item_idx)))
      union all select 'supply_demand', (select avg(covered::int) from ({_COVERED}))
      union all select 'class_reference', (select count(*) filter (others >= 1) / count(*) from ({_REFERENCES}))
      union all select 'coverage', (select count(distinct item_idx) from sample join items using (item_idx) where legality = 'legal')
        / (select count(*) from items where legality = 'legal')
      union all select 'archetype_distance', (select avg(d) from (
        select basket, min(list_distance(vec, centroid)) as d from vectors cross join centres group by basket))),
    judged as (select g.metric, kind, value, case when coalesce(value >= coalesce(low, value) and value <= coalesce(high, value), false)
        then 'pass' when kind = 'hard' then 'fail' else 'prerelease' end as status
      from (values {_GATE_ROWS}) g(metric, kind, low, high) left join m using (metric))
    select metric, kind, {r6('value')} as value, status from judged
    union all select 'overall', null, null, case when bool_or(status = 'fail') then 'fail' when bool_or(status = 'prerelease') then 'prerelease'
      else 'pass' end from judged""", ", ".join((_JACCARD, _SCORED, _LOGITS, _SETS, _POOLED, _CENTRES))))
def quality_gates(spark, folder):
    """All gates; those whose metric is not measured here (calibration, underplayed) have no value and miss."""
    index, lines, heads, sample, train = _sets(spark, folder)
    facets = index.select("item_idx", F.col("version").alias("facet"))
    legal = E.legality_rate(heads, B.legality_reasons(lines, heads, index), lines.join(facets, "item_idx"))
    rows = _with(lines, index, "bucket", F.col("version").alias("facet"))
    covered = E.supply_demand(rows, F.col("facet") == "LARGE", F.col("facet") == "SMALL")
    texts = index.withColumn("text", F.concat(F.lit("Your "), F.col("classes")[0], F.lit(" characters get +1 {S}.")))
    vectors = V.basket_vectors(lines, b.item_vectors(spark, folder, index), DIM)
    near = K.nearest_centroid(vectors, K.label_centroids(_points(spark, folder), "label", DIM))
    measured = {
        "legality_rate": legal.select("legal_rate"), "evaluator_auroc": M.roc_auc(_scored(spark, folder)).select("auc"),
        "held_out_nll": M.soft_ce_entropy(_logits(spark, folder), ["basket"], 0.0).select("ce"),
        "diversity": E.jaccard_diversity(lines).select("diversity"),
        "curve_kl": E.curve_kl(_with(sample, index, "bucket"), _with(train, index, "bucket"), 12).select("kl"),
        "flag_distance_pp": E.flag_share(_with(sample, index, "flag"), _with(train, index, "flag")).select("distance_pp"),
        "supply_demand": covered.agg(F.avg(F.col("covered").cast("double"))),
        "class_reference": E.reference_compliance(lines, texts).select("rate"),
        "coverage": E.coverage(sample, index).select("coverage"), "archetype_distance": near.agg(F.avg("distance")),
    }
    metrics = None
    for name, value in measured.items():
        one = value.toDF("value").select(F.lit(name).alias("metric"), F.col("value").cast("double").alias("value"))
        metrics = one if metrics is None else metrics.unionByName(one)
    gated = cut_lineage(E.quality_gates(metrics, E.gate_table(spark)))
    overall = E.overall_status(gated).select(
        F.lit("overall").alias("metric"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("value"), F.col("overall").alias("status"))
    return gated.select("metric", "kind", round6(F.col("value")).alias("value"), "status").unionByName(overall)


# --- proposals and scores ----------------------------------------------------------------

def _tables(spark, folder):
    """Index, lines, headers, keys of baskets, item vectors and priors."""
    index, lines, heads = b.stored(spark, folder)
    keys = cut_lineage(heads.select("basket", facet_key(F.col("facets")).alias("facet_key")))
    priors = SC.item_priors(lines.join(keys, "basket"), index)
    vectors = cut_lineage(b.item_vectors(spark, folder, index).join(index.select("item_idx", "cap"), "item_idx"))
    return index, lines, heads, keys, vectors, priors


def _scene(spark, folder, archetypes=None):
    """The same and the written candidates."""
    index, lines, heads, keys, vectors, priors = _tables(spark, folder)
    allowed = index.filter("legality <> 'banned'").select("item_idx")
    pool = SA.pools(heads, index).join(allowed, "item_idx", "left_semi")
    return index, lines, heads, keys, vectors, priors, SC.candidate_table(vectors, priors, pool, DIM, archetypes)


def _top(spark, folder, scorer, k, archetypes=None):
    """The k best candidates of all baskets."""
    _, lines, _, keys, vectors, priors, candidates = _scene(spark, folder, archetypes)
    return SC.top_candidates(SC.partial_baskets(lines, vectors, keys, priors, DIM), candidates, scorer, k)


_PRIORS_OF_ITEMS = """kf as (select facet_key, item_idx, sum(qty) as n from lines join played using (basket) group by all),
    kt as (select facet_key, sum(n) as total from kf group by facet_key),
    af as (select item_idx, sum(n) as n from kf group by item_idx),
    priors as (select t.facet_key, i.item_idx,
        ln((coalesce(kf.n, 0) + 100 * (coalesce(af.n, 0) + 1) / ((select sum(n) from af) + (select count(*) from items)))
          / (t.total + 100)) as lp,
        coalesce(kf.n / t.total, af.n / (select sum(n) from af), 0) as meta
      from kt t cross join items i left join af using (item_idx) left join kf on kf.facet_key = t.facet_key and kf.item_idx = i.item_idx)"""
_PRIORS = _PRIORS_OF_ITEMS + """,
    means as (select basket, list(a order by dim) as mean, sqrt(sum(a * a)) as len from cells group by basket),
    pairs as (select m.basket, v.item_idx, lp, meta, lp + list_inner_product(mean, vec) / len as logit,
        list_inner_product(mean, vec) / len as cos, list_distance(mean, vec) as dist,
        v.facet is distinct from p.barred and v.legality <> 'banned' as legal
      from means m join played p using (basket) cross join (select * from item_vectors join (select item_idx, legality from items) using (item_idx)) v
      join priors on priors.facet_key = p.facet_key and priors.item_idx = v.item_idx),
    lse as (select basket, ln(sum(exp(logit))) as lse from pairs group by basket),
    open as (select * from pairs anti join lines using (basket, item_idx) where legal)"""
_PRIOR_NEEDS = "lines played items item_vectors"


@query("proposal_topk", with_ctes(_PRIOR_NEEDS, f"""
    select basket, position, item_idx, {r6('logit - lse')} as log_p from (
      select *, row_number() over (partition by basket order by logit desc, item_idx) as position from open)
    join lse using (basket) where position <= 5""", _POOLED + ", " + _PRIORS))
def proposal_topk(spark, folder):
    top = _top(spark, folder, SC.Scorer(), 5)
    return top.select("basket", "position", "item_idx", round6(F.col("score")).alias("log_p"))


# Partial baskets: one copy drawn out of each; of an item at its cap no more may be proposed.
_PARTIAL = _DRAWN.replace(f"range({K_DRAWS})", "range(1)") + """,
    left_lines as (select l.basket, l.item_idx, qty - (l.item_idx = removed)::int as qty from removed r join lines l using (basket)
      where qty - (l.item_idx = removed)::int > 0),
    left_cells as (select basket, dim, sum(qty * v) / sum(qty) as a from (
      select basket, qty, unnest(vec) as v, generate_subscripts(vec, 1) - 1 as dim from left_lines join item_vectors using (item_idx)) group by all)"""


@query("proposal_partial_topk", with_ctes(_PRIOR_NEEDS, f"""
    , left_means as (select basket, list(a order by dim) as mean, sqrt(sum(a * a)) as len from left_cells group by basket),
    left_pairs as (select m.basket, v.item_idx, lp, lp + list_inner_product(mean, vec) / len as logit,
        v.facet is distinct from p.barred and v.legality <> 'banned' and coalesce(o.qty < v.cap, true) as open
      from left_means m join played p using (basket)
      cross join (select * from item_vectors join (select item_idx, legality, cap from items) using (item_idx)) v
      join priors on priors.facet_key = p.facet_key and priors.item_idx = v.item_idx
      left join left_lines o on o.basket = m.basket and o.item_idx = v.item_idx),
    left_lse as (select basket, ln(sum(exp(logit))) as lse from left_pairs group by basket)
    select basket, position, item_idx, {r6('logit - lse')} as log_p from (
      select *, row_number() over (partition by basket order by logit desc, item_idx) as position from left_pairs where open)
    join left_lse using (basket) where position <= 5""",
    ", ".join((_PARTIAL, _PRIORS_OF_ITEMS))))
def proposal_partial_topk(spark, folder):
    """The next item of baskets that one drawn copy was taken from, own items allowed up to their cap."""
    _, lines, _, keys, vectors, priors, candidates = _scene(spark, folder)
    partials = SA.partial_draws(lines, 1, b.SEED).drop("draw", "removed")
    baskets = SC.partial_baskets(partials, vectors, keys, priors, DIM)
    top = SC.top_candidates(baskets, candidates, SC.Scorer(), 5, exclude_own=False)
    return top.select("basket", "position", "item_idx", round6(F.col("score")).alias("log_p"))


_BLEND = "logit - lse + 1.5 / (1 + exp(-cos)) + 0.5 * dist - 2.0 * meta"


@query("blended_topk", with_ctes(_PRIOR_NEEDS, f"""
    select basket, position, item_idx, {r6('score')} as score from (
      select *, row_number() over (partition by basket order by score desc, item_idx) as position
      from (select basket, item_idx, {_BLEND} as score from open join lse using (basket))) where position <= 5""", _POOLED + ", " + _PRIORS))
def blended_topk(spark, folder):
    top = _top(spark, folder, SC.Scorer(presets=(SC.Preset("blend", 1.5, 0.5, 2.0),)), 5)
    return top.select("basket", "position", "item_idx", round6(F.col("score")).alias("score"))


@query("archetype_topk", with_ctes(_PRIOR_NEEDS, f"""
    , far as (select item_idx, min(list_distance(vec, centroid)) as away from item_vectors cross join centres group by item_idx)
    select basket, position, item_idx, {r6('score')} as score, {r6('away')} as novelty from (
      select *, row_number() over (partition by basket order by score desc, item_idx) as position from (
        select basket, item_idx, away, logit - lse + 1.5 / (1 + exp(-cos)) + 0.5 * away - 2.0 * meta as score
        from open join lse using (basket) join far using (item_idx))) where position <= 5""", _POOLED + ", " + _CENTRES.replace("means", "label_means") + ", " + _PRIORS))
def archetype_topk(spark, folder):
    """The blend with novelty as the distance of an item to its nearest archetype."""
    centres = K.label_centroids(_points(spark, folder), "label", DIM)
    scorer = SC.Scorer(presets=(SC.Preset("blend", 1.5, 0.5, 2.0),), novelty="archetype")
    return _top(spark, folder, scorer, 5, centres).select(
        "basket", "position", "item_idx", round6(F.col("score")).alias("score"), round6(F.col("novelty")).alias("novelty"))


# Slider stops with their (alpha, gamma, lambda); between them lie the means of neighbours.
STOPS = (SC.Preset("safe", 2.0, 0.0, 2.0), SC.Preset("balanced", 1.0, 2.0, 1.0), SC.Preset("brew", 0.5, 6.0, 0.0))
STYLES = tuple((p.name, p.alpha, p.gamma, p.lam) for p in SC.with_midpoints(STOPS))
_STYLED = """
    , picks as (select basket, """ + ", ".join(
        f"arg_max(dist, logit + {a} / (1 + exp(-cos)) + {g} * dist - {m} * meta) as {n}" for n, a, g, m in STYLES) + """
      from open group by basket),
    s as (select preset, avg(d) as novelty, any_value(no) as no from (
      """ + " union all ".join(f"select '{n}' as preset, {i} as no, {n} as d from picks" for i, (n, *_) in enumerate(STYLES)) + f""") group by preset),
    styled as (select preset, {r6('novelty')} as novelty, case when lag(novelty) over w is not null and lead(novelty) over w is not null then
      novelty between least(lag(novelty) over w, lead(novelty) over w) and greatest(lag(novelty) over w, lead(novelty) over w) end as between_neighbours
    from s window w as (order by no))"""


def _styles(spark, folder):
    picks = _top(spark, folder, SC.Scorer(presets=tuple(SC.Preset(*s) for s in STYLES)), 1)
    return E.style_report(picks, [s[0] for s in STYLES])


@query("style_interpolation", with_ctes(_PRIOR_NEEDS, _STYLED + " select * from styled", _POOLED + ", " + _PRIORS))
def style_interpolation(spark, folder):
    return _styles(spark, folder).select("preset", round6(F.col("novelty")).alias("novelty"), F.col("between").alias("between_neighbours"))


@query("styles_interpolatable", with_ctes(
    _PRIOR_NEEDS, _STYLED + " select bool_and(between_neighbours) as interpolatable from styled where between_neighbours is not null", _POOLED + ", " + _PRIORS))
def styles_interpolatable(spark, folder):
    """May the slider be moved freely between its stops?"""
    return E.interpolatable(_styles(spark, folder))


def _training_pairs(spark, folder, phases):
    """Labelled pair features per phase, one draw per basket; baskets get their vectors once for all phases."""
    index, lines, heads, keys, vectors, priors = _tables(spark, folder)
    n = index.count()
    removed = cut_lineage(SA.leave_one_out(lines, 1, b.SEED))
    partials = SC.partial_baskets(SA.partial_draws(lines, 1, b.SEED).drop("removed"), vectors, keys, priors, DIM, ("basket", "draw"))
    examples = None
    for phase in phases:
        drawn = SA.evaluator_examples(SA.negatives(removed, lines, heads, index, phase, b.SEED, n)).withColumn("phase", F.lit(phase))
        examples = drawn if examples is None else examples.unionByName(drawn)
    pairs = SC.pair_features(examples.drop("removed"), partials, vectors, priors, ("basket", "draw"), ("phase",))
    return cut_lineage(pairs.select("phase", "label", "log_prior", "distance", "cosine"))


@query("plausibility_model")
def plausibility_model(spark, folder):
    """Weights fitted on random negatives, judged per negative type."""
    pairs = _training_pairs(spark, folder, SA.PHASES)
    weights = MO.fit_plausibility(pairs.filter("phase = 'random'"))
    scored = MO.apply_plausibility(pairs, weights)
    auc = M.roc_auc(scored, "logit", "label", ["phase"])
    return auc.withColumn("bias", F.lit(weights.bias)).withColumn("cosine", F.lit(weights.cosine)).withColumn(
        "distance", F.lit(weights.distance)).withColumn("prior", F.lit(weights.prior))


# Given weights of the plausibility logit; fitted ones are judged by ``plausibility_model``.
GIVEN = SC.Weights(-0.5, 2.0, -0.7, 0.3)


@query("batch_scores", with_ctes(_PRIOR_NEEDS, f"""
    select basket, position, item_idx, {r6('v')} as value from (
      select *, row_number() over (partition by basket order by v desc, item_idx) as position from (
        select basket, item_idx, 1 / (1 + exp(-({GIVEN.bias} + {GIVEN.cosine} * cos + {GIVEN.distance} * dist + {GIVEN.prior} * lp))) as v
        from open)) where position <= 3""", _POOLED + ", " + _PRIORS))
def batch_scores(spark, folder):
    """Best three legal candidates of every basket by plausibility under given weights."""
    scorer = SC.Scorer(weights=GIVEN, presets=(SC.Preset("value", alpha=1.0),), use_log_p=False)
    return _top(spark, folder, scorer, 3).select("basket", "position", "item_idx", round6(F.col("value")).alias("value"))
