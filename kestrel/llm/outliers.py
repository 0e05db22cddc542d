"""Quality rules: fixed base rules, then robust multivariate outliers.

Every text gives a vector of transformed statistics.  Per (language,
source) and per language a minimum-covariance-determinant estimate (location
and scatter of the ``subset`` share of documents that lie closest together) is
found by concentration steps: from seven robust starts, all for two steps, the
two of smallest determinant until it stays the same, the smaller one counts.
Documents whose squared Mahalanobis distance is above a chi-square quantile are
rejected.  An estimate over n documents is drawn to the next wider one (source
to language, language to all languages) with the weight of ``prior`` documents,
at every n alike.

DataFrame functions only.  Texts are read once: the statistics are written
to the shared folder, the steps run on that table by partial aggregation
(a hot group is a few rows per task), with a row per group and start as the
state between steps: location and inverse factor of the scatter as two arrays.
The subset holds exactly its share: distances are counted in a fixed
logarithmic grid, and the rows of the cell where the share ends weigh what is
missing to it.

Cases: null text counts as empty; texts without words have 0 in all counts
and fail the base rules; null languages or sources are groups of their own;
repeated rows are judged alike; equal distances fall on the same side; an
empty table gives an empty table; a group whose statistics do not vary has a
scatter floor, so its documents lie at distance 0 and stay; input columns
named like the outputs are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines")
#: Transformed statistic -> its scatter floor (a standard deviation).
FEATURES = {"word_length": 0.25, "symbols": 0.25, "dup_lines": 0.08, "repeats": 0.06, "upper": 0.06, "marks": 0.08}
OUTS = (*COUNTS, "base_failed", "kept", "distance")


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(hashes: Column, width: int = 8) -> Column:
    """Words inside windows of ``width`` words that occur twice or more."""
    def covered(at: Column) -> Column:
        # at: ascending starts of repeated windows; each adds what the next one does not
        gaps = F.transform(at, lambda a, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - a, F.lit(width))))
        return F.aggregate(gaps, F.lit(0), lambda s, g: s + g)

    def in_sorted(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return let(F.array_sort(F.transform(same, lambda x: x["i"])), covered)

    def of_windows(w: Column) -> Column:
        pairs = F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), let(F.array_sort(pairs), in_sorted)).otherwise(0)

    windows = let(hashes, lambda x: F.transform(F.sequence(F.lit(1), F.size(x) - (width - 1)),
                                                lambda i: F.xxhash64(F.slice(x, i, width))))
    return F.when(F.size(hashes) >= width, let(windows, of_windows)).otherwise(0)


def text_counts(text: Column) -> Column:
    """The counts of a whole text as a struct of longs."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
            let(F.transform(w, lambda x: F.xxhash64(x)), lambda x: _repeat_words(x)).alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))

    both = let(words, of_words), let(lines, of_lines)
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    return F.struct(both[0].alias("w"), both[1].alias("l"), count(r"[#*$%&|<>]").alias("n_symbols"),
                    count(r"\p{Lu}").alias("n_upper"), count(r"[^\p{L}\s]").alias("n_marks"))


def _features() -> dict[str, Column]:
    """Rates by word, drawn to a usual value by 30 (lengths: 60) words, so that short texts vary less."""
    n = F.col("n_words")
    rate = lambda c: F.col(c) / (n + 30)
    return {
        "word_length": (F.col("word_chars") + 60 * 5.0) / (n + 60),
        "symbols": F.log1p(20 * rate("n_symbols")),
        "dup_lines": F.col("n_dup_lines") / (F.col("n_lines") + 4),
        "repeats": rate("n_repeat_words"),
        "upper": F.log1p(rate("n_upper")),
        "marks": F.log1p(rate("n_marks")),
    }


def _gamma_p(a: float, x: float) -> float:
    """Regularised lower incomplete gamma function, by its series."""
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _gamma_p(dof / 2, mid / 2) < p else (lo, mid)
    return lo


def _at(i: int, j: int) -> int:
    """Place of (i, j <= i) in a lower triangle stored by rows."""
    return i * (i + 1) // 2 + j


P = len(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]
_X = [f"x{i}" for i in range(P)]
STARTS = 7
# What follows is written as SQL text: thousands of small column objects would cost the driver more than the work.
_ROW, _COL = (f"get(array({', '.join(str(p[k]) for p in PAIRS)}), k)" for k in (0, 1))
_TRIANGLE = "cast(({0} * ({0} + 1)) div 2 as int)"


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once: an expression repeated inside a lambda is computed each time."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _factor(cov: str) -> str:
    """Lower Cholesky factor of a scatter, both stored by rows."""
    row_i, row_j = _TRIANGLE.format(_ROW), _TRIANGLE.format(_COL)
    dot = f"aggregate(zip_with(slice(l, {row_i} + 1, {_COL}), slice(l, {row_j} + 1, {_COL}), (a, b) -> a * b), 0D, (s, x) -> s + x)"
    left = f"(get({cov}, k) - {dot})"
    value = f"case when {_ROW} = {_COL} then sqrt(greatest({left}, 1e-12D)) else {left} / get(l, {row_j} + {_COL}) end"
    return f"aggregate(sequence(0, {len(PAIRS) - 1}), cast(array() as array<double>), (l, k) -> concat(l, array({value})))"


def _inverse(factor: str) -> str:
    """Inverse of a lower factor, both stored by rows."""
    row_i = _TRIANGLE.format(_ROW)
    below = (f"aggregate(sequence({_COL}, greatest({_ROW} - 1, {_COL})), 0D, "
             f"(s, t) -> s + get({factor}, {row_i} + t) * get(v, {_TRIANGLE.format('t')} + {_COL}))")
    diagonal = f"get({factor}, {row_i} + {_ROW})"
    value = f"case when {_ROW} = {_COL} then 1 / {diagonal} else -{below} / {diagonal} end"
    return f"aggregate(sequence(0, {len(PAIRS) - 1}), cast(array() as array<double>), (v, k) -> concat(v, array({value})))"


def _state(moments: DataFrame, *keep: str) -> DataFrame:
    """keep, m, c (scatter with its floors of 1), w (inverse factor) and
    logdet from ``m`` and the scatter ``c``."""
    floored = "array(" + ", ".join(f"get(c, {k}) + {1 if i == j else 0}D" for k, (i, j) in enumerate(PAIRS)) + ")"
    logdet = "2 * (" + " + ".join(f"ln(get(low, {_at(i, i)}))" for i in range(P)) + ")"
    found = f"named_struct('c', cov, 'w', {_inverse('low')}, 'logdet', {logdet})"
    found = _bound(floored, "cov", _bound(_factor("cov"), "low", found))
    return moments.select(*keep, "m", F.expr(found).alias("__f")).select(*keep, "m", "__f.c", "__f.w", "__f.logdet")


def distance() -> Column:
    """Squared distance of x0, x1, ... by m and w, as one expression."""
    y = (" + ".join(f"get(w, {_at(i, j)}) * (x{j} - get(m, {j}))" for j in range(i + 1)) for i in range(P))
    return F.expr(" + ".join(f"power({v}, 2)" for v in y))


def _sums(rows: DataFrame, weight: str, *by: str) -> DataFrame:
    """__n, __1 and __2: weighted numbers, sums and products of the rows, by group."""
    first = ", ".join(f"sum({weight} * {x})" for x in _X)
    second = ", ".join(f"sum({weight} * {_X[i]} * {_X[j]})" for i, j in PAIRS)
    return rows.groupBy(*by).agg(F.expr(f"sum({weight})").alias("__n"), F.expr(f"array({first})").alias("__1"), F.expr(f"array({second})").alias("__2"))


def _moments(sums: DataFrame) -> DataFrame:
    """m and c from the sums."""
    sums = sums.where("__n > 0").withColumn("m", F.expr("transform(__1, v -> v / __n)"))
    c = ", ".join(f"get(__2, {k}) / __n - get(m, {i}) * get(m, {j})" for k, (i, j) in enumerate(PAIRS))
    return sums.withColumn("c", F.expr(f"array({c})")).drop("__1", "__2", "__n")


def _starts(pool: DataFrame, path: str) -> DataFrame:
    """gid, start, m, c: moments under six weights that fall with the distance
    from the medians, and the quartiles themselves."""
    spark = pool.sparkSession
    quart = pool.groupBy("gid").agg(F.expr("array(" + ", ".join(f"percentile_approx({x}, array(0.25, 0.5, 0.75), 10000)" for x in _X) + ")").alias("q"))
    quart.select("gid", F.expr("transform(q, v -> v[1])").alias("m"), F.expr("transform(q, v -> sqrt(power((v[2] - v[0]) / 1.349D, 2) + 1))").alias("__s")
                 ).write.parquet(f"{path}/quartiles")
    quart = spark.read.schema("gid string, m array<double>, __s array<double>").parquet(f"{path}/quartiles")
    z = [f"(({x} - get(m, {i})) / get(__s, {i}))" for i, x in enumerate(_X)]
    seen = pool.join(quart, "gid").select("gid", *_X, F.expr(" + ".join(f"power({v}, 2)" for v in z)).alias("r"),
                                          F.expr(f"greatest({', '.join(f'abs({v})' for v in z)})").alias("most"))
    weights = f"1D, 1 / (1 + r / {P}), 1 / (r + 0.1D), if(most <= 2.5D, 1D, 1e-9D), if(r <= {P}, 1D, 1e-9D), exp(-r / {2 * P})"
    seen = seen.select("gid", *_X, F.expr(f"posexplode(array({weights}))").alias("start", "__v"))
    diagonal = "array(" + ", ".join(f"power(get(__s, {i}), 2) - 1" if i == j else "0D" for i, j in PAIRS) + ")"
    return _moments(_sums(seen, "__v", "gid", "start")).unionByName(
        quart.select("gid", F.lit(STARTS - 1).alias("start"), "m", F.expr(diagonal).alias("c")))


_STATE = "gid string, start int, n long, last double, m array<double>, c array<double>, w array<double>, logdet double"


def mcd(pool: DataFrame, path: str, subset: float = 0.75, steps: int = 30, still: float = 1e-4) -> DataFrame:
    """Rows gid, n, m, c, w, logdet: location, scatter and inverse factor of each
    group of ``pool`` (columns gid and x0, x1, ..., in units of their floors)."""
    spark = pool.sparkSession
    # the scatter of the closest share is too small by this factor (chi-square)
    factor = subset / _gamma_p(P / 2 + 1, chi2_quantile(subset, P) / 2)
    first = _state(_starts(pool, path), "gid", "start")
    first.select("gid", "start", F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("last"), "m", "c", "w", "logdet").write.parquet(f"{path}/state0")
    cell = F.floor(16 * F.log2(F.col("__d2") + 1e-6))
    by = ("gid", "start")

    def step(state: DataFrame, k: int) -> DataFrame:
        """One scan: sums by cell of the distance, then those of the closest share."""
        rows = pool.join(state.select(*by, "m", "w"), "gid").select(*by, *_X, distance().alias("__d2"))
        cells = _sums(rows.withColumn("cell", cell), "1D", *by, "cell")  # a few hundred cells a group
        whole, so_far = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("cell")
        n = F.col("__n")
        cells = cells.withColumns({"all": F.sum(n).over(whole), "upto": F.sum(n).over(so_far)})
        part = F.least(F.greatest((F.ceil(subset * F.col("all") - 1e-9) - F.col("upto") + n) / n, F.lit(0.0)), F.lit(1.0))
        cells = cells.withColumn("__p", part).where("__p > 0")
        total = lambda c, size: F.expr("array(" + ", ".join(f"sum(__p * get({c}, {i}))" for i in range(size)) + ")").alias(c)
        near = cells.groupBy(*by).agg(F.first("all").cast("long").alias("n"), F.sum(F.col("__p") * n).alias("__n"),
                                      total("__1", P), total("__2", len(PAIRS)))
        sums = _moments(near).withColumn("c", F.expr(f"transform(c, v -> v * {factor!r}D)"))
        sums = sums.join(state.select(*by, F.col("logdet").alias("last")), list(by))
        _state(sums, *by, "n", "last").select(*by, "n", "last", "m", "c", "w", "logdet").write.parquet(f"{path}/state{k}")
        return spark.read.schema(_STATE).parquet(f"{path}/state{k}")

    state = spark.read.schema(_STATE).parquet(f"{path}/state0")
    for k in (1, 2):
        state = step(state, k)
    best = Window.partitionBy("gid").orderBy("logdet", "start")
    state = state.withColumn("__r", F.row_number().over(best)).where("__r <= 2").drop("__r")
    moving = F.abs(F.col("logdet") - F.col("last")) > still
    done = [state]
    for k in range(3, steps + 1):
        if k > 3 and not state.where(moving).limit(1).count():
            break
        state = step(state if k == 3 else state.where(moving), k)
        done.append(state)
    latest = done[0].withColumn("__k", F.lit(0))
    for k, s in enumerate(done[1:], 1):
        latest = latest.unionByName(s.withColumn("__k", F.lit(k)))
    found = F.struct("__k", "n", "m", "c", "w", "logdet")
    latest = latest.groupBy("gid", "start").agg(F.max(found).alias("f"))
    chosen = latest.groupBy("gid").agg(F.min(F.struct("f.logdet", "start", "f")).alias("b")).select("gid", "b.f.*").drop("__k")
    chosen.write.parquet(f"{path}/mcd")
    return spark.read.schema("gid string, n long, m array<double>, c array<double>, w array<double>, logdet double").parquet(f"{path}/mcd")


def _drawn(own: DataFrame, wide: DataFrame, prior: float, on: list[str], *keep: str) -> DataFrame:
    """``own`` (m, c, n) drawn to ``wide`` (wm, wc) with the weight of ``prior`` documents."""
    joined = own.join(wide, on) if on else own.crossJoin(F.broadcast(wide))  # on nothing: ``wide`` is one row
    n = F.col("n")
    draw = lambda a, b: F.zip_with(a, b, lambda x, y: (n * x + prior * y) / (n + prior))
    return joined.select(*keep, draw("m", "wm").alias("m"), draw("c", "wc").alias("c"))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  carry: list[str] | None = None, prior: float = 30.0, tail: float = 1e-9) -> DataFrame:
    """The ``carry`` columns (default all) with the counts, base_failed,
    distance (squared, null if base_failed) and kept."""
    spark = docs.sparkSession
    path = scratch_path(spark, "quality-rules")
    carry = [c for c in (docs.columns if carry is None else carry) if c not in OUTS]
    (docs.select(F.struct(*[docs[c] for c in carry]).alias("row"), docs[lang].cast("string").alias("lang"),
                 docs[source].cast("string").alias("source"), text_counts(docs[text]).alias("c"))
     .write.parquet(f"{path}/stats"))
    c = F.col
    stats = spark.read.parquet(f"{path}/stats").select(
        "row", "lang", "source", *[c(f"c.w.{x}").cast("long").alias(x) for x in ("n_words", "word_chars", "n_repeat_words")],
        *[c(f"c.l.{x}").cast("long").alias(x) for x in ("n_dup_lines", "n_lines")],
        *[c(f"c.{x}").cast("long").alias(x) for x in ("n_symbols", "n_upper", "n_marks")])
    stats = stats.withColumn("base_failed", (c("n_words") < 20) | (100 * c("n_repeat_words") > 30 * c("n_words")))
    good = ~c("base_failed")
    features = _features()
    null = F.lit("\u0001")
    la, so = F.coalesce("lang", null), F.coalesce("source", null)
    stats = stats.withColumns({x: features[f] / floor for x, (f, floor) in zip(_X, FEATURES.items())}
                              | {"lid": la, "gid": F.concat(la, F.lit("\u0002"), so)})

    pool = stats.where(good).select(F.explode(F.array("gid", "lid")).alias("gid"), *_X)
    found = mcd(pool, path)
    of_source = found.where(c("gid").contains("\u0002")).withColumn("lid", F.substring_index("gid", "\u0002", 1))
    of_lang = found.where(~c("gid").contains("\u0002")).withColumnRenamed("gid", "lid")
    mean = lambda a, size: F.expr("array(" + ", ".join(f"sum(n * get({a}, {k})) / sum(n)" for k in range(size)) + ")")
    overall = of_lang.agg(mean("m", P).alias("wm"), mean("c", len(PAIRS)).alias("wc")).where("wm[0] is not null")
    wide = _drawn(of_lang, overall, prior, [], "lid").select("lid", c("m").alias("wm"), c("c").alias("wc"))
    # floors are in the scatters already
    bare = F.expr("array(" + ", ".join(f"get(c, {k}) - {1 if i == j else 0}D" for k, (i, j) in enumerate(PAIRS)) + ")")
    _state(_drawn(of_source, wide, prior, ["lid"], "gid").withColumn("c", bare), "gid").select("gid", "m", "w").write.parquet(f"{path}/params")
    params = spark.read.schema("gid string, m array<double>, w array<double>").parquet(f"{path}/params")
    scored = stats.join(params, "gid", "left").withColumn("d2", distance())  # base_failed rows may be in no group
    limit = chi2_quantile(1 - tail, P)
    inside = F.coalesce(c("d2") <= limit, F.lit(True))
    return scored.select(*[c(f"row.{x}").alias(x) for x in carry], *COUNTS, "base_failed",
                         (good & inside).alias("kept"), F.when(good, c("d2")).alias("distance"))
