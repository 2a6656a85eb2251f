"""The recording queries over the driver's tables, each with its SQL counterpart.

Users of `events` and labels of `embeddings` stand for episodes; thresholds suit their values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tracecut.functions import kernel as K
from tracecut.operators import cuts as C
from tracecut.operators import datasets as S
from tracecut.operators import detect as D
from tracecut.plans import workflows as W
from tracecut.sources.frames import event_frames, vector_frames

FPS = 30.0
#: The chain's thresholds at the scale of event values.
CHAIN = C.Config(
    fps=4.0, smooth_frames=1, mutation_change=60.0, baseline_tolerance=20.0, gripper_drop=40.0, gripper_reopen=40.0, gripper_peak_slack=5.0, gripper_contact_gap=-60.0, gripper_contact_max_position=25.0,
    release_distance=20.0, release_search_seconds=5.0, joint_step=250.0, joint_action_ratio=20.0, arm_step=40.0, max_lead_seconds=1.0, tail_seconds=2.0,
    right_state=["v"], right_action=["a"], left_state=["a"], left_action=["v"], gripper="v", gripper_action="a", xyz=["v", "a"],
)
#: Others, under which all kinds of rejections occur: smoothed signals, durations of their own, and jumps that the action does not explain.
STRICT = C.Config(
    fps=8.0, smooth_frames=3, baseline_frames=5, mutation_change=30.0, baseline_tolerance=12.0, gripper_drop=15.0, gripper_reopen=15.0, gripper_peak_slack=4.0, gripper_contact_gap=-80.0, gripper_contact_max_position=60.0,
    release_distance=30.0, release_search_seconds=0.7, joint_step=210.0, joint_action_ratio=4.0, arm_step=8.0, start_seconds=0.4, motion_seconds=0.25, quiet_seconds=0.2, delay_seconds=0.15, max_lead_seconds=0.4, tail_seconds=1.0,
    right_state=["v"], right_action=["a"], left_state=["v"], left_action=["a"], gripper="v", gripper_action="a", xyz=["v", "a"],
)
CHAIN_COLUMNS = ["ep", "length", "status", "reason", "cut1", "cut2", "cut3", "cut4", "left_start", "task_end", "n_closures"]

FR = "fr AS (SELECT user_id AS ep, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS f, value AS v, json_extract_string(props, '$.k')::DOUBLE AS a FROM events)"
VF = "vf AS (SELECT label::BIGINT AS ep, (row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1)::BIGINT AS f, embedding::DOUBLE[] AS x FROM embeddings)"
ST = "st AS (SELECT *, abs(lead(v) OVER w - v) AS sv, abs(lead(a) OVER w - a) AS sa FROM fr WINDOW w AS (PARTITION BY ep ORDER BY f))"
EP = "e AS (SELECT ep, count(*) AS length FROM fr GROUP BY ep)"


def lasting(condition: str, k: int) -> str:
    return f"(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING) = {k})"


def runs(name: str, source: str, condition: str, k: int) -> str:
    return f"{name} AS (SELECT ep, min(f) AS start, max(f) AS stop FROM (SELECT ep, f, f - row_number() OVER (PARTITION BY ep ORDER BY f) AS i FROM {source} WHERE {condition}) GROUP BY ep, i HAVING count(*) >= {k})"


def onset(name: str, column: str, threshold: float, k: int) -> str:
    away = f"abs({column} - c0) > {threshold}::DOUBLE"
    return f"{name} AS (SELECT ep, min(CASE WHEN hit THEN f END) AS onset FROM (SELECT ep, f, {lasting(away, k)} AS hit FROM (SELECT *, first_value({column}) OVER (PARTITION BY ep ORDER BY f) AS c0 FROM fr)) GROUP BY ep)"


def mutation(name: str, column: str, change: float, tolerance: float, source: str = "fr", baseline: int = 8) -> str:
    return f"""{name}_d AS (SELECT ep, f, abs({column} - (median({column}) FILTER (WHERE f < {baseline}) OVER (PARTITION BY ep))) AS d FROM {source}),
    {name}_h AS (SELECT *, min(CASE WHEN d >= {change}::DOUBLE AND f > 0 THEN f END) OVER (PARTITION BY ep) AS h FROM {name}_d),
    {name} AS (SELECT ep, CASE WHEN any_value(h) IS NOT NULL THEN coalesce(max(CASE WHEN f > 0 AND f < h AND d <= {tolerance}::DOUBLE THEN f END), 0) END AS cut FROM {name}_h GROUP BY ep)"""


def stop(name: str, action: str, state: str, least: float, k: int, bounds: str, quiet: int | None = None, delay: int | None = None) -> str:
    """bounds: a table of ep, lo, hi."""
    quiet, delay = max(1, k - 1) if quiet is None else quiet, k if delay is None else delay
    return f"""{runs(name + "_r", "st", f"{action} >= {least}::DOUBLE", k)},
    {name}_l AS (SELECT ep, arg_max(r.stop, r.start) AS rs FROM {name}_r r JOIN {bounds} b USING (ep) WHERE r.stop >= lo AND r.start < hi GROUP BY ep),
    {name}_q AS (SELECT ep, f, {state} >= {least}::DOUBLE AS moving, {lasting(f"{state} < {least}::DOUBLE", quiet)} AS quiet FROM st),
    {name}_c AS (SELECT ep, min(CASE WHEN quiet AND f > rs THEN f END) AS c, count(*) AS n FROM {name}_q JOIN {name}_l USING (ep) GROUP BY ep),
    {name} AS (SELECT ep, c + {delay} AS stop, CASE WHEN bool_or(coalesce(moving, false) AND f < c) THEN '{state[1:]}' ELSE '' END AS channels FROM {name}_c JOIN {name}_q USING (ep) WHERE c + {delay} < n GROUP BY ep, c)"""


def closures(name: str, drop: float, reopen: float, slack: float, most: float, gap: float, source: str = "fr") -> str:
    closes = f"open AND greatest(peak, x.v) - x.v >= {drop}::DOUBLE"
    opens = f"NOT open AND x.v - least(low, x.v) >= {reopen}::DOUBLE"
    contact = f"{opens} AND least(low, x.v) <= {most}::DOUBLE AND least(low, x.v) - least(alow, x.a) >= {gap}::DOUBLE"
    at = f"CASE WHEN x.v >= greatest(peak, x.v) - {slack}::DOUBLE THEN x.f ELSE place END"
    return f"""{name}_w AS (SELECT ep, f, true AS open, v AS peak, 0::BIGINT AS place, v AS low, a AS alow, []::BIGINT[] AS closures, []::BIGINT[] AS contacts, []::BIGINT[] AS releases FROM {source} WHERE f = 0
      UNION ALL SELECT x.ep, x.f, CASE WHEN open THEN NOT ({closes}) ELSE {opens} END, CASE WHEN open THEN greatest(peak, x.v) WHEN {opens} THEN x.v ELSE peak END,
        CASE WHEN open THEN {at} WHEN {opens} THEN x.f ELSE place END, CASE WHEN open THEN x.v ELSE least(low, x.v) END, CASE WHEN open THEN x.a ELSE least(alow, x.a) END,
        CASE WHEN {closes} THEN list_append(closures, {at}) ELSE closures END, CASE WHEN {contact} THEN list_append(contacts, closures[-1]) ELSE contacts END, CASE WHEN {contact} THEN list_append(releases, x.f) ELSE releases END
      FROM {name}_w w JOIN {source} x ON x.ep = w.ep AND x.f = w.f + 1),
    {name} AS (SELECT ep, arg_max(closures, f) AS closures, arg_max(contacts, f) AS contacts, arg_max(releases, f) AS releases FROM {name}_w GROUP BY ep)"""


def smoothing(column: str, n: int) -> str:
    before = n // 2
    terms = []
    for o in range(-before, n - before):
        x = column if not o else f"coalesce(lag({column}, {-o}) OVER w, first_value({column}) OVER p)" if o < 0 else f"coalesce(lead({column}, {o}) OVER w, last_value({column}) OVER p)"
        terms.append(f"{x} * {1 / n!r}::DOUBLE")
    return " + ".join(terms)


WINDOWS = "WINDOW w AS (PARTITION BY ep ORDER BY f), p AS (PARTITION BY ep ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def chain_sql(c: C.Config) -> str:
    ahead, tail, lead, delay = (C.frames_of(x, c.fps) for x in (c.release_search_seconds, c.tail_seconds, c.max_lead_seconds, c.delay_seconds))
    start, motion, quiet = C.frames_of(c.start_seconds, c.fps, 1), C.frames_of(c.motion_seconds, c.fps, 1), max(1, C.frames_of(c.quiet_seconds, c.fps) - 1)
    s = f"{c.arm_step}::DOUBLE"
    la, ra, ls, rs = (f"s{x[0]}" for x in (c.left_action, c.right_action, c.left_state, c.right_state))
    states, actions = (" + ".join(f"r{x} * r{x}" for x in xs) for xs in (c.right_state + c.left_state, c.right_action + c.left_action))
    top = ", ".join(f"r{x}" for x in c.right_state + c.left_state)
    smooth = ", ".join(f"{smoothing(x, c.smooth_frames)} AS {x}" if c.smooth_frames > 1 else x for x in ("v", "a"))

    def early(name, found, stable, search):
        return f"{name} AS (SELECT DISTINCT r.ep FROM {found} r JOIN {stable} b USING (ep) WHERE r.stop >= b.{search} AND r.start <= b.stable AND b.stable <= r.stop AND b.stable - r.start > {lead})"

    def stop_at(name, action, state, bounds):
        return stop(name, action, state, c.arm_step, motion, bounds, quiet, delay)

    return f"""WITH RECURSIVE {FR}, fs AS (SELECT ep, f, {smooth} FROM fr {WINDOWS}),
    st AS (SELECT *, abs(lead(v) OVER w - v) AS sv, abs(lead(a) OVER w - a) AS sa FROM fs WINDOW w AS (PARTITION BY ep ORDER BY f)), {EP},
    sr AS (SELECT ep, abs(lead(v) OVER w - v) AS rv, abs(lead(a) OVER w - a) AS ra FROM fr WINDOW w AS (PARTITION BY ep ORDER BY f)),
    jump AS (SELECT DISTINCT ep FROM sr WHERE rv IS NOT NULL AND greatest({top}) >= {c.joint_step}::DOUBLE AND CASE WHEN {actions} = 0 THEN true ELSE sqrt({states}) / sqrt({actions}) >= {c.joint_action_ratio}::DOUBLE END),
    {mutation("m", c.right_state[0], c.mutation_change, c.baseline_tolerance, "fs", c.baseline_frames)},
    {closures("g", c.gripper_drop, c.gripper_reopen, c.gripper_peak_slack, c.gripper_contact_max_position, c.gripper_contact_gap, "fs")},
    rel AS (SELECT g.ep, releases[2] AS release, len(closures) AS n_closures, v AS bv, a AS ba FROM g LEFT JOIN fs ON fs.ep = g.ep AND fs.f = releases[2]),
    c2 AS (SELECT fs.ep, min(f) AS cut2 FROM fs JOIN rel USING (ep) WHERE f BETWEEN release AND release + {ahead} AND sqrt((v - bv) * (v - bv) + (a - ba) * (a - ba)) >= {c.release_distance}::DOUBLE GROUP BY fs.ep),
    ls AS (SELECT ep, min(CASE WHEN hit THEN f END) AS left_start FROM (SELECT ep, f, {lasting(f"{la} >= {s}", start)} AS hit FROM st JOIN c2 USING (ep) WHERE f >= cut2 + 1) GROUP BY ep),
    b3 AS (SELECT ep, cut2 + 1 AS lo, left_start AS hi, cut2 FROM c2 JOIN ls USING (ep) WHERE left_start IS NOT NULL),
    {stop_at("s3", ra, rs, "b3")},
    b4 AS (SELECT ep, s3.stop + 1 AS lo, length - {tail} AS hi, s3.stop AS cut3, s3.stop - {delay} AS stable, cut2 FROM s3 JOIN e USING (ep) JOIN c2 USING (ep)),
    {stop_at("s4", la, ls, "b4")},
    b5 AS (SELECT ep, s4.stop + 1 AS lo, length AS hi, s4.stop - {delay} AS stable, cut3 FROM s4 JOIN e USING (ep) JOIN b4 USING (ep)),
    {stop_at("s5", ra, rs, "b5")},
    {runs("lr", "st", f"{la} >= {s}", motion)}, {runs("rr", "st", f"{ra} >= {s}", motion)},
    {early("el", "lr", "b4", "cut2")}, {early("er", "rr", "b5", "cut3")},
    a AS (SELECT e.ep, length, jump.ep IS NOT NULL AS jumps, greatest(m.cut, 1) AS cut1, release, n_closures, c2.cut2, left_start, s3.stop AS cut3, s4.stop AS cut4, s5.stop AS task_end, el.ep IS NOT NULL AS early_left, er.ep IS NOT NULL AS early_right, m.cut IS NULL AS no_cut1
      FROM e LEFT JOIN jump USING (ep) LEFT JOIN m USING (ep) LEFT JOIN rel USING (ep) LEFT JOIN c2 USING (ep) LEFT JOIN ls USING (ep) LEFT JOIN s3 USING (ep) LEFT JOIN s4 USING (ep) LEFT JOIN s5 USING (ep) LEFT JOIN el USING (ep) LEFT JOIN er USING (ep)),
    r AS (SELECT *, CASE WHEN jumps THEN 'discontinuity' WHEN no_cut1 THEN 'no mutation' WHEN release IS NULL THEN 'contacts' WHEN cut2 IS NULL THEN 'release_distance' WHEN left_start IS NULL THEN 'no left motion'
      WHEN cut3 IS NULL THEN 'no right stop' WHEN early_left THEN 'early_left' WHEN length - {tail} - (cut3 + 1) < {c.baseline_frames} THEN 'short tail' WHEN cut4 IS NULL THEN 'no left stop' WHEN early_right THEN 'early_right'
      WHEN NOT (cut1 < cut2 AND cut2 < cut3 AND cut3 < cut4) THEN 'order' ELSE '' END AS reason FROM a)
    SELECT ep, length, CASE WHEN reason = '' THEN 'ok' WHEN reason IN ('discontinuity', 'release_distance', 'early_left', 'early_right') THEN 'rejected' ELSE 'error' END AS status, reason,
      {", ".join(f"CASE WHEN reason = '' THEN {n} END AS {n}" for n in ("cut1", "cut2", "cut3", "cut4", "left_start", "task_end"))}, CASE WHEN reason = '' THEN n_closures::INT END AS n_closures FROM r"""


def points(spark, d):
    return D.trim_points(event_frames(spark, d), {"value": (["v"], 60.0), "action": (["a"], 40.0)})


POINTS = f"""{onset("ov", "v", 60.0, 3)}, {onset("oa", "a", 40.0, 3)},
    pt0 AS (SELECT e.ep, length, least(oa.onset, ov.onset) AS motion, oa.onset AS o1, ov.onset AS o2 FROM e JOIN oa USING (ep) JOIN ov USING (ep)),
    pt AS (SELECT ep, length, motion, coalesce(greatest(motion - 3, 0), 0) AS trim, CASE WHEN motion IS NULL THEN 'none' ELSE concat_ws(',', CASE WHEN o1 = motion THEN 'action' END, CASE WHEN o2 = motion THEN 'value' END) END AS trigger FROM pt0)"""

RUNS = runs("mr", "st", "sv >= 10::DOUBLE", 5)


def motion(spark, d):
    return D.motion_runs(event_frames(spark, d), ["v"], 10.0, 5)


def bounded(spark, d):
    f = event_frames(spark, d)
    return D.arm_stop(f, ["v"], ["a"], 30.0, 3, F.lit(5), F.lit(40))


def overlap(spark, d):
    stable = D.episodes(event_frames(spark, d)).select("ep", F.floor(F.col("length") / 2).alias("stable"), F.lit(3).alias("search_start"))
    return D.early_overlap(motion(spark, d), stable, 4)


def pause(spark, d, smooth=1):
    return D.longest_pause(event_frames(spark, d), ["v", "a"], "a", "v", 20.0, 2, 60.0, 2, 3, smooth).drop("length")


def pause_sql(smooth: int = 1) -> str:
    v, a = (smoothing(c, smooth) if smooth > 1 else c for c in ("v", "a"))
    return f"""rl AS (SELECT ep, coalesce(min(CASE WHEN hit THEN f END), max(f)) AS release FROM (SELECT ep, f, {lasting("a > a0 + 20::DOUBLE", 2)} AS hit FROM (SELECT *, first_value(a) OVER (PARTITION BY ep ORDER BY f) AS a0 FROM fr)) GROUP BY ep),
    sm AS (SELECT ep, f, {v} AS v, {a} AS a FROM fr {WINDOWS}),
    sp AS (SELECT *, sqrt((lead(v) OVER w - v) * (lead(v) OVER w - v) + (lead(a) OVER w - a) * (lead(a) OVER w - a)) AS speed FROM sm WINDOW w AS (PARTITION BY ep ORDER BY f)),
    ins AS (SELECT ep, release, arg_min(f, (-v, f)) FILTER (WHERE f <= release) AS insertion FROM sm JOIN rl USING (ep) GROUP BY ep, release),
    pj AS (SELECT sp.*, insertion, release FROM sp JOIN ins USING (ep)),
    {runs("pr", "pj", "f >= insertion AND f < release AND speed < 60::DOUBLE", 1)},
    pc AS (SELECT ep, start, pr.stop + 1 AS stop FROM pr JOIN ins USING (ep) WHERE pr.stop + 1 < release AND pr.stop + 1 - start >= 2 AND start > 3),
    pb AS (SELECT ep, arg_min(start, (start - stop, start)) AS start, arg_min(stop, (start - stop, start)) AS stop FROM pc GROUP BY ep)"""


PAUSE = pause_sql()


def reindexed(spark, d):
    out = S.without_episodes(event_frames(spark, d), pause(spark, d).filter("start IS NOT NULL"))
    return out.groupBy("ep", "new_ep").agg(F.min("index").alias("first_index"), F.max("index").alias("last_index"), F.count(F.lit(1)).alias("length"))


def intervals(spark, d):
    """Thirds of an episode from frame 3 on."""
    e = D.episodes(event_frames(spark, d))
    third = F.floor((F.col("length") - 3) / 3)
    each = F.array(*(F.struct((F.lit(3) + third * i).alias("start"), (F.lit(3) + third * (i + 1)).alias("stop")) for i in range(3)))
    return e.select("ep", "length", F.posexplode(each).alias("ordinal", "x")).select("ep", "length", "ordinal", "x.start", "x.stop")


IV = "iv AS (SELECT ep, length, i::INT AS ordinal, 3 + ((length - 3) // 3) * i AS start, 3 + ((length - 3) // 3) * (i + 1) AS stop FROM e, range(3) t(i))"


def segments(spark, d):
    return S.segment_frames(event_frames(spark, d), intervals(spark, d).select("ep", "ordinal", "start", "stop"))


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def given(spark, d):
    """Overrides as a hand-edited report would give them: none for every seventh user, too large a one for every eleventh."""
    return points(spark, d).filter("ep % 7 <> 0").select("ep", F.when(F.col("ep") % 11 == 0, F.col("length") + 5).otherwise(F.col("trim") + 1).alias("trim"))


GIVEN = "gv AS (SELECT ep, CASE WHEN ep % 11 = 0 THEN length + 5 ELSE trim + 1 END AS trim FROM pt WHERE ep % 7 <> 0)"


def indexed(spark, d):
    """Frames with a running number over all, as a rebuilt dataset has them."""
    f = event_frames(spark, d)
    return f.join(S.numbered(D.episodes(f)), "ep").withColumn("index", F.col("base") + F.col("f")).withColumn("frame_index", F.col("f"))


def nearest(spark, d):
    f = event_frames(spark, d)
    stamps = f.select("ep", "f", (F.col("f") / FPS).alias("t"))
    cuts = F.array(*(F.struct(F.lit(i).alias("cut_no"), (F.col("length") * x / FPS).alias("time")) for i, x in enumerate((0.13, 0.37, 0.5, 0.81), 1)))
    times = D.episodes(f).select("ep", F.explode(cuts).alias("x")).select("ep", "x.cut_no", "x.time")
    return D.nearest_frames(stamps, times)


def trimmed(spark, d):
    return S.rekeyed(event_frames(spark, d), points(spark, d), FPS).select("ep", "new_ep", "frame_index", "index", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"), "v")


def vector_steps(spark, d):
    w = K.ordered()
    f = vector_frames(spark, d).withColumn("y", F.lead("x").over(w)).filter("y IS NOT NULL")
    return f.select("ep", "f", F.round(F.array_max(F.zip_with("x", "y", lambda a, b: F.abs(b - a))), 9).alias("step"))


def release(spark, d):
    f = vector_frames(spark, d).select("ep", "f", *(F.get("x", F.lit(i)).alias(n) for i, n in enumerate("xyz")))
    return D.release_distance(f, ["x", "y", "z"], F.lit(10), 0.35, 30)


def mapping(spark, d):
    """Kept users with the label of their documents, if any, as an older dataset's provenance."""
    old = spark.read.parquet(f"{d}/labels.parquet").groupBy(F.col("doc_id").alias("ep")).agg(F.max("quality").alias("quality"))
    kept = reindexed(spark, d).select("ep", "new_ep")
    return kept.join(old, "ep", "left").select("ep", "new_ep", "quality")


def changed(spark, d):
    new = nearest(spark, d).groupBy("ep").pivot("cut_no", [1, 2, 3, 4]).agg(F.first("frame")).toDF("ep", "cut1", "cut2", "cut3", "cut4")
    old = D.episodes(event_frames(spark, d)).select("ep", *(F.floor(F.col("length") * x).alias(f"cut{i}") for i, x in enumerate((0.13, 0.37, 0.5, 0.81), 1)))
    return S.changed_cuts(old, new, ["cut1", "cut2", "cut3", "cut4"])


NEAR = f"""tm AS (SELECT ep, i::INT AS cut_no, length * [0.13::DOUBLE, 0.37::DOUBLE, 0.5::DOUBLE, 0.81::DOUBLE][i] / 30.0::DOUBLE AS time FROM e, range(1, 5) t(i)),
    nf AS (SELECT ep, cut_no, arg_min(f, (abs(f / 30.0::DOUBLE - time), f)) AS frame FROM fr JOIN tm USING (ep) GROUP BY ep, cut_no)"""

def described(spark, d):
    """Intervals with the text that an annotation gives them, beside a task of two steps."""
    text = F.when(F.col("ep") % 4 == 0, "other").otherwise(F.concat(F.lit("step "), F.col("ordinal")))
    steps = spark.createDataFrame([(0, "a", "step 0"), (1, "b", "step 1")], "ordinal int, id string, description string")
    return S.labelled(intervals(spark, d).withColumn("subtask", text), steps).select("ep", "ordinal", "id", "description", "problem")


def resegmented(spark, d):
    """Intervals as episodes of their own, numbered by ranges."""
    plan = S.numbered(intervals(spark, d).withColumn("order", F.struct("ep", "ordinal")).withColumn("length", F.col("stop") - F.col("start")).filter("length > 0"), "order", spread=True)
    out = S.renumbered(event_frames(spark, d), plan.select("ep", "new_ep", "base", "start", "stop", "ordinal"), FPS)
    return out.select("ep", "new_ep", "ordinal", "frame_index", "index", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"), "v")


def cut_times(spark, d):
    frames = event_frames(spark, d)
    found = W.timed(C.find_cuts(frames, CHAIN), frames.withColumn("timestamp", (F.col("f") / FPS).cast("float")))
    names = [f"time{i}" for i in range(1, 5)] + ["task_end_time"]
    return found.filter("status = 'ok'").select("ep", *(F.round(n, 5).alias(n) for n in names))


def moved_cuts(spark, d):
    """Episodes of which a time, as hand-edited, or its frame differs."""
    frames = D.episodes(event_frames(spark, d)).select("ep", *(F.floor(F.col("length") * x).alias(f"cut{i}") for i, x in enumerate((0.13, 0.37, 0.5, 0.81), 1)))
    old = frames.select("*", *((F.col(f"cut{i}") / FPS).alias(f"time{i}") for i in range(1, 5)))
    shift = F.when(F.col("ep") % 6 == 0, 1e-3).when(F.col("ep") % 6 == 1, 1e-12).otherwise(0.0)
    new = frames.withColumn("cut4", F.when(F.col("ep") % 6 == 2, F.col("cut4") + 1).otherwise(F.col("cut4"))).select("*", *((F.col(f"cut{i}") / FPS + shift).alias(f"time{i}") for i in range(1, 5))).withColumn("time4", (F.floor(F.col("cut4")) / FPS + shift))
    return S.changed_cuts(old, new.withColumn("time4", F.when(F.col("ep") % 6 == 2, (F.col("cut4") - 1) / FPS).otherwise(F.col("time4"))), C.CUTS, [f"time{i}" for i in range(1, 5)])


def owners(spark, d):
    """Orders with their customers; one without would be an error."""
    customers = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("ep"), "c_name")
    return W.matched(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("ep")), customers, "c_name").select("ep", "o_orderkey", "c_name")


def documents_of(spark, d):
    """Statistics of two scalars and of a vector as documents have them, rounded."""
    frames = vector_frames(spark, d).select("ep", "f", F.slice("x", 1, 3).alias("x"), F.get("x", F.lit(5)).alias("y"))
    found = S.feature_stats(frames, {"x": "place", "y": "grip", "f": "frame_index"})
    return found.select("ep", "feature", *(F.transform(c, lambda v: F.round(v, 6)).alias(c) for c in ("min", "max", "mean", "std")), "count")


STATS = "min({c}) AS min, max({c}) AS max, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std, count({c}) AS count"


def _queries() -> dict:
    """name -> (query, SQL)."""
    q = {}
    ev = event_frames
    q["smooth_edge_padded"] = (lambda s, d: ev(s, d).select("ep", "f", F.round(K.smoothed(F.col("v"), 5), 6).alias("s")), f"WITH {FR} SELECT ep, f, round({smoothing('v', 5)}, 6) AS s FROM fr {WINDOWS}")
    q["abs_step"] = (lambda s, d: D.with_steps(ev(s, d), ["v"]).filter("step_v IS NOT NULL").select("ep", "f", F.round("step_v", 6).alias("step")), f"WITH {FR}, {ST} SELECT ep, f, round(sv, 6) AS step FROM st WHERE sv IS NOT NULL")
    q["vector_step_max"] = (vector_steps, f"WITH {VF} SELECT ep, f, round(list_max(list_transform(list_zip(x, y), lambda p: abs(p[2] - p[1]))), 9) AS step FROM (SELECT *, lead(x) OVER (PARTITION BY ep ORDER BY f) AS y FROM vf) WHERE y IS NOT NULL")
    q["sustained_onset"] = (lambda s, d: D.sustained_onset(ev(s, d), ["v"], 60.0, 3), f"WITH {FR}, {onset('o', 'v', 60.0, 3)} SELECT * FROM o")
    q["trim_points"] = (points, f"WITH {FR}, {EP}, {POINTS} SELECT * FROM pt")
    q["trim_reindex"] = (
        trimmed,
        f"""WITH {FR}, {EP}, {POINTS}, nb AS (SELECT ep, trim, row_number() OVER (ORDER BY ep) - 1 AS new_ep, coalesce(sum(length - trim) OVER (ORDER BY ep ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM pt WHERE length > trim)
        SELECT ep, new_ep, f - trim AS frame_index, base + f - trim AS index, round(((f - trim)::DOUBLE / 30)::FLOAT::DOUBLE, 4) AS timestamp, v FROM fr JOIN nb USING (ep) WHERE f >= trim""",
    )
    q["motion_runs"] = (motion, f"WITH {FR}, {ST}, {RUNS} SELECT * FROM mr")
    most = "max({0}) OVER (PARTITION BY ep ORDER BY f ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)"
    q["sustained_start"] = (
        lambda s, d: D.motion_start(ev(s, d), ["v", "a"], 30.0, 4, F.lit(5)),
        f"WITH {FR}, {ST}, h AS (SELECT ep, f, {lasting('greatest(sv, sa) >= 30::DOUBLE', 4)} AS hit, {most.format('sv')} AS mv, {most.format('sa')} AS ma FROM st WHERE f >= 5) SELECT ep, min(CASE WHEN hit THEN f END) AS motion, arg_min(CASE WHEN mv >= ma THEN 'v' ELSE 'a' END, f) FILTER (WHERE hit) AS channel FROM h GROUP BY ep",
    )
    q["arm_stop"] = (bounded, f"WITH {FR}, {ST}, {EP}, b AS (SELECT ep, 5 AS lo, 40 AS hi FROM e), {stop('s', 'sv', 'sa', 30.0, 3, 'b')} SELECT * FROM s")
    q["task_end"] = (
        lambda s, d: D.episodes(ev(s, d)).select("ep").join(D.arm_stop(ev(s, d), ["v"], ["a"], 30.0, 3, F.lit(30), F.lit(1 << 40)), "ep", "left"),
        f"WITH {FR}, {ST}, {EP}, b AS (SELECT ep, 30 AS lo, {1 << 40} AS hi FROM e), {stop('s', 'sv', 'sa', 30.0, 3, 'b')} SELECT ep, stop, channels FROM e LEFT JOIN s USING (ep)",
    )
    q["early_overlap"] = (overlap, f"WITH {FR}, {ST}, {EP}, {RUNS} SELECT ep, max(length // 2 - start) AS lead FROM mr JOIN e USING (ep) WHERE mr.stop >= 3 AND start <= length // 2 AND length // 2 <= mr.stop AND length // 2 - start > 4 GROUP BY ep")
    q["discontinuity"] = (
        lambda s, d: rounded(D.discontinuity(ev(s, d), ["v"], ["a"], 100.0, 5.0), "jump"),
        f"WITH {FR}, {ST} SELECT ep, arg_min(f, (-sv, f)) AS frame, round(max(sv), 6) AS jump FROM st WHERE sv >= 100::DOUBLE AND (sa = 0 OR sv / sa >= 5) GROUP BY ep",
    )
    q["release_distance"] = (
        release,
        f"""WITH {VF}, p AS (SELECT ep, f, x[1] AS x, x[2] AS y, x[3] AS z FROM vf), b AS (SELECT * FROM p WHERE f = 10)
        SELECT p.ep, min(CASE WHEN p.f BETWEEN 10 AND 40 AND sqrt((p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) + (p.z - b.z) * (p.z - b.z)) >= 0.35::DOUBLE THEN p.f END) AS cut FROM p LEFT JOIN b USING (ep) GROUP BY p.ep""",
    )
    q["mutation"] = (lambda s, d: D.mutation(ev(s, d), ["v"], 100.0, 20.0).withColumnRenamed("v", "cut"), f"WITH {FR}, {mutation('m', 'v', 100.0, 20.0)} SELECT * FROM m")
    q["any_channel_mutation"] = (
        lambda s, d: D.any_mutation(ev(s, d), ["v", "a"], 45.0, 20.0),
        f"WITH {FR}, {mutation('m1', 'v', 45.0, 20.0)}, {mutation('m2', 'a', 45.0, 20.0)} SELECT ep, least(m1.cut, m2.cut) AS cut, CASE WHEN m1.cut <= coalesce(m2.cut, m1.cut) THEN 'v' WHEN m2.cut IS NOT NULL THEN 'a' END AS channel FROM m1 JOIN m2 USING (ep)",
    )
    q["hysteresis_closures"] = (lambda s, d: D.closures(ev(s, d), "v", "a", 60.0, 60.0, 5.0, 25.0, -60.0), f"WITH RECURSIVE {FR}, {closures('g', 60.0, 60.0, 5.0, 25.0, -60.0)} SELECT * FROM g")
    q["cut_pipeline"] = (lambda s, d: C.find_cuts(ev(s, d), CHAIN).select(*CHAIN_COLUMNS), chain_sql(CHAIN))
    q["cut_pipeline_strict"] = (lambda s, d: C.find_cuts(ev(s, d), STRICT).select(*CHAIN_COLUMNS), chain_sql(STRICT))
    q["cut_status"] = (lambda s, d: C.status_counts(C.find_cuts(ev(s, d), STRICT)), f"SELECT s.status, count(r.ep) AS n FROM (VALUES ('ok'), ('rejected'), ('error')) s(status) LEFT JOIN ({chain_sql(STRICT)}) r ON r.status = s.status GROUP BY s.status")
    q["release_frame"] = (lambda s, d: D.release_frame(ev(s, d), "a", 20.0, 2), f"WITH {FR}, {PAUSE} SELECT * FROM rl")
    q["longest_pause"] = (pause, f"WITH {FR}, {PAUSE} SELECT ep, insertion, release, start, stop FROM ins LEFT JOIN pb USING (ep)")
    kept = f"""{FR}, {EP}, {PAUSE}, kp AS (SELECT ep, row_number() OVER (ORDER BY ep) - 1 AS new_ep, coalesce(sum(length) OVER (ORDER BY ep ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base, length FROM e WHERE ep NOT IN (SELECT ep FROM pb))"""
    q["filter_reindex"] = (reindexed, f"WITH {kept} SELECT ep, new_ep, base AS first_index, base + length - 1 AS last_index, length FROM kp")
    q["mapping_left_join"] = (mapping, f"WITH {kept} SELECT ep, new_ep, quality FROM kp LEFT JOIN (SELECT doc_id AS ep, max(quality) AS quality FROM labels GROUP BY doc_id) USING (ep)")
    q["segment_range_join"] = (lambda s, d: segments(s, d).select("ep", "ordinal", "frame_index", "f", "v"), f"WITH {FR}, {EP}, {IV} SELECT ep, ordinal, f - start AS frame_index, f, v FROM fr JOIN iv USING (ep) WHERE f >= start AND f < iv.stop")
    q["segment_stats"] = (
        lambda s, d: rounded(S.scalar_stats(segments(s, d), ["ep", "ordinal"], ["v", "a"]), "mean", "std"),
        f"WITH {FR}, {EP}, {IV}, s AS (SELECT ep, ordinal, v, a FROM fr JOIN iv USING (ep) WHERE f >= start AND f < iv.stop) SELECT ep, ordinal, 'v' AS feature, {STATS.format(c='v')} FROM s GROUP BY ep, ordinal UNION ALL SELECT ep, ordinal, 'a', {STATS.format(c='a')} FROM s GROUP BY ep, ordinal",
    )
    q["vector_stats"] = (lambda s, d: rounded(S.vector_stats(vector_frames(s, d), ["ep"], "x"), "mean", "std"), f"WITH {VF}, u AS (SELECT ep, unnest(x) AS x, unnest(range(64))::INT AS dim FROM vf) SELECT ep, dim, {STATS.format(c='x')} FROM u GROUP BY ep, dim")
    q["sample_count"] = (lambda s, d: D.episodes(ev(s, d)).select("ep", S.sample_count(F.col("length") * 7).alias("n")), f"WITH {FR}, {EP} SELECT ep, greatest(least(length * 7, 100), least(floor(pow(length * 7, 0.75::DOUBLE)), 10000))::BIGINT AS n FROM e")
    q["nearest_frame"] = (nearest, f"WITH {FR}, {EP}, {NEAR} SELECT * FROM nf")
    q["changed_cuts"] = (changed, f"WITH {FR}, {EP}, {NEAR} SELECT DISTINCT ep FROM nf JOIN e USING (ep) WHERE frame <> floor(length * [0.13::DOUBLE, 0.37::DOUBLE, 0.5::DOUBLE, 0.81::DOUBLE][cut_no])")
    q["override_join"] = (
        lambda s, d: S.overridden(points(s, d), given(s, d)).select("ep", "length", "trim", "problem"),
        f"WITH {FR}, {EP}, {POINTS}, {GIVEN} SELECT ep, length, gv.trim, CASE WHEN gv.trim IS NULL THEN 'missing' WHEN gv.trim < 0 OR gv.trim >= length THEN 'out of range' END AS problem FROM pt LEFT JOIN gv USING (ep)",
    )
    q["missing_overrides"] = (lambda s, d: S.missing_keys(points(s, d), given(s, d)), f"WITH {FR}, {EP}, {POINTS}, {GIVEN} SELECT ep FROM pt WHERE ep NOT IN (SELECT ep FROM gv)")
    q["interval_contiguity"] = (
        lambda s, d: S.contiguity(intervals(s, d).withColumn("start", F.when((F.col("ep") % 5 == 0) & (F.col("ordinal") == 1), F.col("start") + 1).otherwise(F.col("start")))).select("ep", "ordinal", "problem"),
        f"WITH {FR}, {EP}, {IV}, iw AS (SELECT ep, length, ordinal, CASE WHEN ep % 5 = 0 AND ordinal = 1 THEN start + 1 ELSE start END AS start, iv.stop FROM iv) SELECT ep, ordinal, CASE WHEN start < 0 OR stop > length THEN 'range' WHEN start >= stop THEN 'order' WHEN lag(stop) OVER (PARTITION BY ep ORDER BY ordinal) <> start THEN 'gap' END AS problem FROM iw",
    )
    q["dataset_summary"] = (
        lambda s, d: rounded(S.trim_summary(points(s, d), FPS), "removed_seconds"),
        f"WITH {FR}, {EP}, {POINTS} SELECT count(*) AS episodes, sum(length)::BIGINT AS source_frames, sum(trim)::BIGINT AS removed_frames, sum(length - trim)::BIGINT AS output_frames, round(sum(trim) / 30.0::DOUBLE, 6) AS removed_seconds, median(trim)::DOUBLE AS median_trim FROM pt",
    )
    q["validate_frame_index"] = (
        lambda s, d: S.frame_index_faults(indexed(s, d).withColumn("frame_index", F.when((F.col("ep") % 9 == 0) & (F.col("f") == 7), F.lit(70)).otherwise(F.col("f")))).select("ep", "f", "frame_index", "place"),
        f"WITH {FR} SELECT ep, f, 70::BIGINT AS frame_index, f AS place FROM fr WHERE ep % 9 = 0 AND f = 7",
    )
    q["validate_global_index"] = (
        lambda s, d: S.global_index_faults(indexed(s, d).withColumn("index", F.when(F.col("ep") % 9 == 0, F.col("index") + 1).otherwise(F.col("index")))),
        f"WITH {FR}, {EP}, b AS (SELECT ep, length, coalesce(sum(length) OVER (ORDER BY ep ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM e) SELECT ep, base + 1 AS lowest, base + length AS highest, length, base FROM b WHERE ep % 9 = 0",
    )
    q["validate_lengths"] = (
        lambda s, d: S.length_faults(ev(s, d), D.episodes(ev(s, d)).select("ep", F.when(F.col("ep") % 9 == 0, F.col("length") + 1).otherwise(F.col("length")).alias("length"))),
        f"WITH {FR}, {EP} SELECT ep, length AS rows, length + 1 AS length FROM e WHERE ep % 9 = 0",
    )
    q["validate_timestamps"] = (
        lambda s, d: S.timestamp_faults(ev(s, d).withColumn("timestamp", (F.col("f") / FPS + F.when(F.col("f") == 3, 0.01).otherwise(0.0)).cast("float")), FPS).select("ep", "f"),
        f"WITH {FR} SELECT ep, f FROM fr WHERE f = 3",
    )
    q["validate_constants"] = (
        lambda s, d: S.constant_faults(ev(s, d).withColumn("task", F.when((F.col("ep") % 9 == 0) & (F.col("f") > 4), 1).otherwise(0)), "task"),
        f"WITH {FR} SELECT DISTINCT ep, 0 AS low, 1 AS high FROM fr WHERE ep % 9 = 0 AND f > 4",
    )
    q["validate_totals"] = (lambda s, d: S.totals(ev(s, d), 100, 3), f"WITH {FR}, {EP} SELECT count(*) AS total_episodes, sum(length)::BIGINT AS total_frames, count(*) * 3 AS total_videos, ceil(count(*) / 100.0)::BIGINT AS total_chunks FROM e")
    q["longest_pause_smoothed"] = (lambda s, d: pause(s, d, 3), f"WITH {FR}, {pause_sql(3)} SELECT ep, insertion, release, start, stop FROM ins LEFT JOIN pb USING (ep)")
    q["episode_limit"] = (lambda s, d: W.limited(ev(s, d), 7).select("ep", "f", "v"), f"WITH {FR} SELECT ep, f, v FROM fr WHERE ep IN (SELECT DISTINCT ep FROM fr ORDER BY ep LIMIT 7)")
    q["id_sequence"] = (
        lambda s, d: S.id_faults(D.episodes(ev(s, d)).withColumn("ep", F.when(F.col("ep") % 3 == 0, F.col("ep") + 1).otherwise(F.col("ep")))),
        f"WITH {FR}, {EP}, i AS (SELECT CASE WHEN ep % 3 = 0 THEN ep + 1 ELSE ep END AS ep FROM e), s AS (SELECT count(*) AS n, min(ep) AS lowest, max(ep) AS highest, count(DISTINCT ep) AS different FROM i) SELECT * FROM s WHERE n > 0 AND (lowest <> 0 OR highest <> n - 1 OR different <> n)",
    )
    q["repeated_keys"] = (lambda s, d: S.repeated_keys(s.read.parquet(f"{d}/orders.parquet"), "o_custkey"), "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 1")
    q["must_match_join"] = (owners, "SELECT o_custkey AS ep, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
    q["interval_labels"] = (
        described,
        f"WITH {FR}, {EP}, {IV}, st AS (SELECT * FROM (VALUES (0, 'a', 'step 0'), (1, 'b', 'step 1')) t(ordinal, id, description)) SELECT ep, ordinal, id, description, CASE WHEN description IS NULL THEN 'missing' WHEN description <> CASE WHEN ep % 4 = 0 THEN 'other' ELSE 'step ' || ordinal END THEN 'text' END AS problem FROM iv LEFT JOIN st USING (ordinal)",
    )
    q["convert_reindex"] = (
        resegmented,
        f"""WITH {FR}, {EP}, {IV}, nb AS (SELECT ep, ordinal, start, stop, row_number() OVER (ORDER BY ep, ordinal) - 1 AS new_ep, coalesce(sum(stop - start) OVER (ORDER BY ep, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base FROM iv WHERE stop > start)
        SELECT ep, new_ep, ordinal, f - start AS frame_index, base + f - start AS index, round(((f - start)::DOUBLE / 30)::FLOAT::DOUBLE, 4) AS timestamp, v FROM fr JOIN nb USING (ep) WHERE f >= start AND f < nb.stop""",
    )
    q["cut_times"] = (cut_times, f"SELECT ep, {', '.join(f'round((cut{i} / 30.0::DOUBLE)::FLOAT::DOUBLE, 5) AS time{i}' for i in range(1, 5))}, round((task_end / 30.0::DOUBLE)::FLOAT::DOUBLE, 5) AS task_end_time FROM ({chain_sql(CHAIN)}) WHERE status = 'ok'")
    q["moved_cuts"] = (moved_cuts, f"WITH {FR}, {EP} SELECT ep FROM e WHERE ep % 6 IN (0, 2)")
    q["stats_documents"] = (
        documents_of,
        f"""WITH {VF}, u AS (SELECT ep, 'place' AS feature, unnest(x[1:3]) AS x, unnest(range(3)) AS dim FROM vf UNION ALL SELECT ep, 'grip', x[6], 0 FROM vf UNION ALL SELECT ep, 'frame_index', f::DOUBLE, 0 FROM vf),
        s AS (SELECT ep, feature, dim, min(x) AS lo, max(x) AS hi, avg(x) AS m, stddev_pop(x) AS sd, count(x) AS n FROM u GROUP BY ALL)
        SELECT ep, feature, {', '.join(f'list(round({c}, 6) ORDER BY dim) AS {n}' for c, n in (('lo', 'min'), ('hi', 'max'), ('m', 'mean'), ('sd', 'std')))}, [any_value(n)] AS count FROM s GROUP BY ep, feature""",
    )
    return q


def queries():
    return {name: query for name, (query, _) in _queries().items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in _queries().items()}
