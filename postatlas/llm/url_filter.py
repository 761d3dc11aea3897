"""URL filters: allow and block rules, then a ratio of character Markov models; DataFrame functions only.

Rules name a host and a path prefix; the longest that fits decides.  URLs that
no rule fits are judged by two smoothed variable-order Markov models of the
characters of host and path, one of rule-accepted URLs, one of rule-rejected
ones.  The models keep every gram of the training URLs, however rare, and
context totals are sums over all of them.  Grams are interpolated with the next
shorter order (Witten-Bell); a gram that training lacks has the probabilities
of its suffix.  A URL's log-likelihood difference is a sum over its characters,
divided by its length, and is compared with a threshold calibrated on the
rules' URLs (largest balanced accuracy over steps of a fixed width).  As a model knows
all grams of its own training URLs, the threshold reads differences of two
folds, each under the counts of the other.

Scale: the last ``order`` characters at a place (its window) decide what the
place adds, so windows are counted and valued once each, and the URLs' windows
are joined with the values by a shuffled equi-join; nothing of the models is
sent to all tasks.

Edge cases: a null URL or one without "://" has an empty host and path, and no
characters: its difference is 0; where one class is missing the method allows
all; repeated pages are judged each; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scale import checkpoint_dir

# Fixed values: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
ORDER = 5
#: What a model is trained on: all rules' URLs, or those outside a fold (the models "0" and "1").
MODELS = {"all": (0, 1), "0": (1,), "1": (0,)}
GRID = 400


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("")), F.coalesce(path, F.lit(""))


def rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path joined), and its verdict; both null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def fold(chars: Column) -> Column:
    """0 or 1 by the text's hash."""
    return F.when(F.substr(F.md5(chars), F.lit(1), F.lit(1)).isin(*"02468ace"), 0).otherwise(1)


def windows(texts: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row for each character of ``chars``: the up to ``order`` characters ending at it."""
    n = F.length("chars")
    at = texts.where(n > 0).select(*keep, "chars", F.explode(F.sequence(F.lit(1), n)).alias("at"))
    size = F.least(F.col("at"), F.lit(order))
    return at.select(*keep, F.substr("chars", F.col("at") - size + 1, size).alias("window"))


def suffixes(some: DataFrame, *keep: str) -> DataFrame:
    """One row for each gram (1 character or more) that ends a window."""
    size = F.explode(F.sequence(F.lit(1), F.length("window"))).alias("size")
    return some.select("window", *keep, size).select(*keep, "window", "size", F.substr("window", F.length("window") - F.col("size") + 1, F.col("size")).alias("gram"))


def counted(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(window, a0, a1, b0, b1): every window of every text with its places in accepted and rejected ones of each fold; texts have chars, verdict, n and fold."""
    cells = {f"{s}{k}": F.sum(F.when((F.col("verdict") == v) & (F.col("fold") == k), F.col("n")).otherwise(F.lit(0))) for s, v in (("a", "allow"), ("b", "block")) for k in (0, 1)}
    return windows(texts, order, "verdict", "n", "fold").groupBy("window").agg(*(x.alias(c) for c, x in cells.items()))


def fit(counts: DataFrame) -> DataFrame:
    """(window, all, 0, 1): what each window adds to a log-likelihood difference, under each of MODELS."""
    cells = ["a0", "a1", "b0", "b1"]
    grams = suffixes(counts, *cells).groupBy("gram", "size").agg(*(F.sum(c).alias(c) for c in cells))
    # c: of the gram; n, t: total and number of the grams that share its context
    whole = Window.partitionBy(F.substr("gram", F.lit(1), F.col("size") - 1))
    c = {(m, s): sum((F.col(f"{s}{k}") for k in folds), F.lit(0)) for m, folds in MODELS.items() for s in "ab"}
    known = grams.select("gram", "size", *(x.alias(f"c{s}{m}") for (m, s), x in c.items()), *(F.sum(x).over(whole).alias(f"n{s}{m}") for (m, s), x in c.items()), *(F.count_if(x > 0).over(whole).alias(f"t{s}{m}") for (m, s), x in c.items()))
    names = [x for x in known.columns if x not in ("gram", "size")]
    chain = suffixes(counts).join(known.drop("size"), "gram").groupBy("window").agg(F.array_sort(F.collect_list(F.struct("size", *names))).alias("chain"))

    # Witten-Bell: (count + types * shorter) / (context + types), from order 1 upwards
    def longer(p: Column, x: Column) -> Column:
        out = []
        for m in MODELS:
            seen = x[f"ca{m}"] + x[f"cb{m}"] > 0
            for s in "ab":
                count, total, types, low = x[f"c{s}{m}"], x[f"n{s}{m}"], x[f"t{s}{m}"], p[s + m]
                out.append(F.when(seen & (total > 0), (count + (types + 1) * low) / (total + types + 1)).otherwise(low).alias(s + m))
        return F.struct(*out)

    start = F.struct(*(F.lit(1.0 / 256).alias(s + m) for m in MODELS for s in "ab"))
    end = F.aggregate("chain", start, longer)
    return chain.select("window", end.alias("p")).select("window", *(F.log(F.col(f"p.a{m}") / F.col(f"p.b{m}")).alias(m) for m in MODELS))


def differences(texts: DataFrame, values: DataFrame, order: int = ORDER) -> DataFrame:
    """Adds ``difference``, the length-normalised log-likelihood difference of each row of ``chars``, and ``held``, the same under the counts of the other fold; rows need a unique ``row``."""
    hit = windows(texts, order, "row", "fold").join(values, "window").groupBy("row").agg(F.sum("all").alias("sum"), F.sum(F.when(F.col("fold") == 0, F.col("0")).otherwise(F.col("1"))).alias("other"))
    each = {"difference": "sum", "held": "other"}
    joined = texts.join(hit, "row", "left")
    return joined.withColumns({c: F.round(F.coalesce(F.col(x) / F.length("chars"), F.lit(0.0)), 9) for c, x in each.items()}).drop(*each.values())


def threshold(scored: DataFrame, grid: int = GRID) -> DataFrame:
    """One row with ``cut``: the multiple of 2 / ``grid`` with the largest balanced accuracy on the rules' URLs (the lowest of equals)."""
    known = scored.where("verdict is not null").select((F.col("verdict") == "allow").alias("good"), F.floor(F.col("held") * (grid // 2)).cast("int").alias("bin"))
    by_bin = known.groupBy("bin").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))  # a difference is a mean of logarithms of counts: a few thousand bins at most
    pairs = by_bin.agg(F.array_sort(F.collect_list(F.struct("bin", "g", "b"))).alias("bins"), F.sum("g").alias("ng"), F.sum("b").alias("nb"))
    # walking up the bins: a cut at a bin accepts it and what lies above
    start = F.struct(F.lit(0).cast("long").alias("g"), F.lit(0).cast("long").alias("b"), F.lit(-1.0).alias("best"), F.lit(None).cast("int").alias("bin"))

    def step(s: Column, x: Column) -> Column:
        value = (F.col("ng") - s["g"]) / F.col("ng") + s["b"] / F.col("nb")
        better = value > s["best"] + 1e-12
        return F.struct((s["g"] + x["g"]).alias("g"), (s["b"] + x["b"]).alias("b"), F.when(better, value).otherwise(s["best"]).alias("best"), F.when(better, x["bin"]).otherwise(s["bin"]).alias("bin"))

    walked = pairs.select("ng", "nb", F.when((F.col("ng") > 0) & (F.col("nb") > 0), F.aggregate("bins", start, step)).alias("end"))
    return walked.select(F.coalesce(F.col("end")["bin"] / F.lit(float(grid // 2)), F.lit(-1e9)).alias("cut"))


def judge(pages: DataFrame, *, order: int = ORDER, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, difference) of every row."""
    host, path = parts(F.col(url_col).cast("string"))
    split = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    # equal host and path have one difference: scored once, joined back by them
    rows = split.select("*", name.alias("rule"), verdict.alias("verdict"))
    row = F.struct(F.xxhash64("host", "path").alias("x"), F.xxhash64(F.lit("row"), "path", "host").alias("y"))
    texts = rows.groupBy("host", "path", "rule", "verdict").agg(F.count("*").alias("n")).select("*", F.concat("host", "path").alias("chars"), row.alias("row"), fold(F.concat("host", "path")).alias("fold"))
    checkpoint_dir(pages.sparkSession)
    scored = differences(texts, fit(counted(texts, order)), order).checkpoint()  # used twice: for the threshold and for the verdicts
    cut = threshold(scored)
    out = scored.crossJoin(F.broadcast(cut)).select("host", "path", F.col("difference"), F.when(F.col("difference") >= F.col("cut"), "allow").otherwise("block").alias("method"))
    joined = rows.join(out, ["host", "path"])
    return joined.select(F.col("page_id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", "method").alias("verdict"), "difference")
