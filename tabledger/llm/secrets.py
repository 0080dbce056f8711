"""Secret scan: fixed formats, and runs of characters that look random to a pair of Markov models.

Everything is a DataFrame expression. The models are two tables of character
transitions, one of the labelled secrets of all documents and one of the ordinary
identifiers of a bounded sample, counted by a grouped aggregation; only the counts
(one number per model and pair of characters) reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The formats of the base scan, in the order of their kinds.
ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
# Names and words: runs of small letters, joined by capitals, dashes or underscores, with a short number at the end.
IDENTIFIER = (r"(?<![A-Za-z0-9+/_=-])[A-Z]?[a-z]++(?:[_-][A-Za-z][a-z]++|[A-Z][a-z]++)*+[0-9]{0,3}+(?![A-Za-z0-9+/_=-])")
LEAST_IDENTIFIER = 8
SAMPLE_DOCS = 20_000
MARGIN = 12.0
BACKOFF = 8.0


def spans_of(text: Column, pattern: str, kind: str, value: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end) in code points; those whose group ``value`` is shorter
    than ``least`` are dropped after matching."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value))
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("len"),
        F.transform(values, F.char_length).alias("val"),
    )
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,val:int>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["len"], F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["val"].alias("val"))
        return F.struct(
            end.alias("at"),
            F.when(x["val"] >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    found = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    bare = F.transform(found, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return F.when(text.rlike(pattern), bare).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>"))


def base_spans(text: Column) -> list[Column]:
    return [spans_of(text, ASSIGN, "assign", 2, 6), spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex")]


def transition_scores(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each pair of ``CHARS``, row by row.

    Trained from labelled strings, each distinct one once: what the base formats match, in any document, is random;
    identifiers elsewhere are ordinary. Only the ordinary ones, which are plentiful, come from a sample of about
    ``sample_docs`` documents at most, chosen by hash. If no document holds a match of a base format all scores are 0.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    picked = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < max(1, int(share * (1 << 20))))
    text = F.col("text")
    secret = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    plain = F.regexp_extract_all(
        F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " "), F.lit(IDENTIFIER), F.lit(0)
    )
    samples = docs.select(F.explode(secret).alias("s"), F.lit(1).alias("random")).where(F.char_length("s") >= 6).unionByName(
        picked.select(F.explode(plain).alias("s"), F.lit(0).alias("random")).where(F.char_length("s") >= LEAST_IDENTIFIER)
    ).groupBy("s", "random").agg(F.lit(1).alias("one")).select("s", "random")
    pairs = samples.select("random", F.explode(F.regexp_extract_all("s", F.lit("(?=(..))"), F.lit(1))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    if not any(k[0] for k in counts):
        return [0.0] * len(CHARS) ** 2
    def log_p(label: int) -> list[float]:
        """Transitions, smoothed towards how often each character follows any other."""
        n = [[counts.get((label, a + b), 0) for b in CHARS] for a in CHARS]
        follows = [sum(column) + smooth for column in zip(*n, strict=True)]
        share = [x / sum(follows) for x in follows]
        return [math.log((x + BACKOFF * p) / (sum(row) + BACKOFF)) for row in n for x, p in zip(row, share, strict=True)]

    return [x - y for x, y in zip(log_p(1), log_p(0), strict=True)]


def random_runs(text: Column, taken: Column, scores: list[float], margin: float = MARGIN) -> Column:
    """Long runs whose log-likelihood ratio is above ``margin`` and that no span of ``taken`` touches."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in scores)), ",").cast("array<double>")
    width = len(CHARS)

    def score(s):
        codes = F.transform(F.split(s, ""), lambda c: F.instr(F.lit(CHARS), c) - 1)
        steps = F.zip_with(
            F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1),
            lambda a, b: F.element_at(table, a * width + b + 1),
        )
        return F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + x)

    runs = spans_of(text, RUN, "markov")
    free = F.filter(runs, lambda r: ~F.exists(taken, lambda t: (t["start"] < r["end"]) & (r["start"] < t["end"])))
    return F.filter(free, lambda r: score(F.substring(text, r["start"] + 1, r["end"] - r["start"])) > margin)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
         margin: float = MARGIN) -> DataFrame:
    """Columns ``doc_id``, ``text`` and ``spans``, an array of (kind, start, end) in code points, end exclusive, ordered
    by start and then by kind as in ``KINDS``.

    A null text is empty and has no span. Rows are independent: repeated rows, null ids and ties give as many rows
    back, an empty table none; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return with_spans(rows, rows, "text", sample_docs, margin)


def with_spans(rows: DataFrame, labelled: DataFrame, text_col: str, sample_docs: int = SAMPLE_DOCS, margin: float = MARGIN,
               name: str = "spans") -> DataFrame:
    """``rows`` with the spans of ``text_col`` in a column ``name``; the models come from ``labelled`` (column ``text``)."""
    scores = transition_scores(labelled, sample_docs)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    based = rows.withColumn(name, F.concat(*base_spans(text)))
    every = F.concat(F.col(name), random_runs(text, F.col(name), scores, margin)) if any(scores) else F.col(name)
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.array_sort(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), rank(s).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return based.withColumn(name, F.transform(keyed, lambda s: F.struct(s["kind"], s["start"], s["end"])))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mark``; ``spans`` ordered by start."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    done = F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
