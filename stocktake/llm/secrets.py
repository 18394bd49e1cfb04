"""Secret scan with fixed patterns and character Markov models, in DataFrame functions only.

Base spans come from three patterns. Further candidates are runs of 16 or more characters of
``[A-Za-z0-9+/_=-]``. Two first-order Markov models over those characters, one of random strings
and one of ordinary identifiers, give each candidate a log-likelihood ratio; a candidate that doesn't touch
a base span is a span of kind ``markov`` if its ratio reaches ``MIN_RATIO`` in all and
``MIN_RATIO_PER_CHAR`` on average. Both models are trained from all texts: what the base
patterns found (random) and the shorter runs of those characters in texts without a finding (ordinary).

Positions are code points, the end exclusive. Spark's ``split`` gives the texts between the matches
of a pattern, ``regexp_extract_all`` the matches; their running lengths are the positions.

Defined cases: a null text is empty, and an empty text has no spans; equal texts have equal
spans; without anything to learn from the models are uniform, and no span
is added. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.text import text_rows

# Fixed patterns. A match of `assign` counts if its value has 6 or more characters; `access` and
# `hex` state their least lengths themselves, which finds the same runs.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE_LENGTH = 16
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LENGTH},}}"
WORD = r"[A-Za-z0-9+/_=-]+"
KINDS = ["assign", "access", "hex", "markov"]
MIN_VALUE = 6
#: Nats of evidence for a random string, in all and by character.
MIN_RATIO, MIN_RATIO_PER_CHAR = 12.0, 0.5
#: Weights of a model's counts of character pairs, of kinds of characters (upper case, lower case, digit, sign), and of
#: single characters in its transitions: the same in both models, whatever their size.
PAIRS, KIND_PAIRS, SINGLES = 0.6, 0.3, 0.1
#: Share of the single characters that is spread evenly, so that one never seen is no evidence.
FLOOR = 0.01
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
REDACTED = "[SECRET]"
NEVER = 2147483647

SPAN = "array<struct<start:int,kind:int,stop:int,size:int>>"
SPAN_FOUND = "array<struct<start:int,kind:int,stop:int,size:int,found:string>>"
#: Elements of a block of a running fold, and code points of a piece of a text that is cut.
RUN_BLOCK, PIECE = 128, 512


def running(values: str, step: str, start: str) -> str:
    """SQL: for each element of an array of ints what ``step`` makes of ``start`` and all elements before it (``t``: so far, ``v``: the element).

    In blocks of ``RUN_BLOCK``: an array that grows by one element a step is copied each time, so one fold over
    all of them would cost the square of their number.
    """
    fold = "aggregate({array}, struct({at} AS at, cast(array() AS array<int>) AS out), ({s}, {v}) -> struct({next} AS at, concat({s}.out, array({s}.at)) AS out), {s} -> {s}.out)"
    inside = fold.format(array="block", at="base", s="s", v="v", next=re.sub(r"\bt\b", "s.at", step))
    bases = fold.format(array="blocks", at=start, s="z", v="block", next=f"aggregate(block, z.at, (t, v) -> {step})")
    blocks = f"transform(sequence(0, greatest(size(all) - 1, 0) div {RUN_BLOCK}), k -> slice(all, k * {RUN_BLOCK} + 1, {RUN_BLOCK}))"
    return f"transform(array({values}), all -> transform(array({blocks}), blocks -> flatten(zip_with(blocks, {bases}, (block, base) -> {inside})))[0])[0]"


def matches(pattern: str, kind: int, value_group: int = 0, found_text: bool = False) -> str:
    """SQL: the spans of a pattern in ``text``, leftmost and non-overlapping; ``size`` is the length of the given group.

    With ``found_text`` a span carries the text found."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"""struct(
        regexp_extract_all(text, '{quoted}', 0) AS t,
        transform(regexp_extract_all(text, '{quoted}', 0), m -> length(m)) AS m,
        transform(regexp_extract_all(text, '{quoted}', {value_group}), v -> length(v)) AS v,
        transform(split(text, '{quoted}', -1), g -> length(g)) AS g)"""
    # An array of one binds a value once. Before match i lie i + 1 gaps and i matches.
    before = running("zip_with(slice(x.g, 1, size(x.m)), x.m, (g, m) -> g + m)", "t + v", "0")
    text = ", x.t[i] AS found" if found_text else ""
    found = f"""transform(array({parts}), x -> transform(array({before}), at -> transform(sequence(0, size(x.m) - 1),
        i -> struct(at[i] + x.g[i] AS start, {kind} AS kind, at[i] + x.g[i] + x.m[i] AS stop, x.v[i] AS size{text})))[0])[0]"""
    return f"if(text RLIKE '{quoted}', {found}, cast(array() AS {SPAN_FOUND if found_text else SPAN}))"


def with_base_spans(rows: DataFrame) -> DataFrame:
    """Adds ``base``: the spans of the fixed patterns, by start and kind."""
    assign = f"filter({matches(ASSIGN, 0, 1)}, s -> s.size >= {MIN_VALUE})"
    found = rows.withColumns({"assign_spans": F.expr(assign), "access_spans": F.expr(matches(ACCESS, 1)), "hex_spans": F.expr(matches(HEX, 2))})
    return found.withColumn("base", F.array_sort(F.concat("assign_spans", "access_spans", "hex_spans"))).drop("assign_spans", "access_spans", "hex_spans")


def pairs_of(tokens: DataFrame) -> DataFrame:
    """``label, a, b, n``: how often character ``b`` follows ``a`` in the tokens of a label."""
    chars = tokens.select("label", F.split("token", "").alias("c"))
    steps = F.expr("transform(sequence(0, size(c) - 2), i -> struct(ascii(c[i]) AS a, ascii(c[i + 1]) AS b))")
    return chars.filter(F.size("c") > 1).select("label", F.explode(steps).alias("s")).groupBy("label", "s.a", "s.b").agg(F.count("*").alias("n"))


def train_ratios(rows: DataFrame) -> list[float]:
    """Log-likelihood ratio of every character pair ``128 * a + b``, random against ordinary.

    Only pairs seen in a text are evidence: what neither model shows says nothing about either."""
    flagged = rows.withColumn("found", F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}"))
    # The values themselves; the name before an `assign` value is ordinary.
    found = [F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) for pattern, group in ((ASSIGN, 1), (ACCESS, 0), (HEX, 0))]
    values = flagged.filter("found").select(F.explode(F.concat(F.filter(found[0], lambda v: F.length(v) >= MIN_VALUE), *found[1:])).alias("value"))
    random = values.select(F.lit(1).alias("label"), F.explode(F.regexp_extract_all("value", F.lit(WORD), F.lit(0))).alias("token"))
    words = flagged.filter(~F.col("found")).select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("token"))
    # Runs as long as a candidate are not labelled: an unknown secret may be among them.
    words = words.filter(F.length("token") < CANDIDATE_LENGTH)
    counts: dict[tuple[int, int, int], int] = {(r.label, r.a, r.b): r.n for r in pairs_of(random.unionByName(words)).collect()}
    return pair_ratios(counts)


def pair_ratios(counts: dict[tuple[int, int, int], int]) -> list[float]:
    """The ratios from counts of ``(label, a, b)``.

    Transitions of pairs back off to those of their kinds (so that few digits are enough to tell a number), and to
    single characters, whose shares have an equal floor in both models."""
    codes, ratios = [ord(c) for c in ALPHABET], [0.0] * (128 * 128)
    models = [transitions({(a, b): counts.get((label, a, b), 0) for a in codes for b in codes}, codes) for label in (0, 1)]
    for a in codes:
        for b in codes:
            if any(counts.get((label, a, b)) for label in (0, 1)):
                ratios[128 * a + b] = math.log(models[1][a, b] / models[0][a, b])
    return ratios


def kind_of(code: int) -> int:
    c = chr(code)
    return 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3


def transitions(n: dict[tuple[int, int], int], codes: list[int]) -> dict[tuple[int, int], float]:
    """Chance of ``b`` after ``a``. A level without counts leaves its weight to the next one."""
    follows, after, kinds = dict.fromkeys(codes, 0), dict.fromkeys(codes, 0), {(j, k): 0 for j in range(4) for k in range(4)}
    for (a, b), count in n.items():
        after[a] += count
        follows[b] += count
        kinds[kind_of(a), kind_of(b)] += count
    whole = max(sum(follows.values()), 1)
    share = {b: (1 - FLOOR) * follows[b] / whole + FLOOR / len(codes) for b in codes}
    of_kind = [sum(share[b] for b in codes if kind_of(b) == k) for k in range(4)]
    chance = {}
    for a in codes:
        j = kind_of(a)
        from_kind = sum(kinds[j, k] for k in range(4))
        for b in codes:
            k = kind_of(b)
            near = kinds[j, k] / from_kind * share[b] / of_kind[k] if from_kind else share[b]
            chance[a, b] = PAIRS * (n[a, b] / after[a] if after[a] else near) + KIND_PAIRS * near + SINGLES * share[b]
    return chance


def apart() -> str:
    """SQL: the ``runs`` that no span of ``base`` touches, by one pass over both in order of their starts.

    A run is touched if a base span before it ends behind its start, or one after it starts before its end."""
    both = """array_sort(concat(
        transform(base, s -> struct(s.start AS start, 0 AS run, s.stop AS stop, s.size AS size, '' AS found)),
        transform(runs, s -> struct(s.start AS start, 1 AS run, s.stop AS stop, s.size AS size, s.found AS found))))"""
    ends = running("transform(both, s -> if(s.run = 0, s.stop, 0))", "greatest(t, v)", "0")
    starts = running(f"transform(reverse(both), s -> if(s.run = 0, s.start, {NEVER}))", "least(t, v)", str(NEVER))
    kept = "filter(both, (s, i) -> s.run = 1 AND before[i] <= s.start AND after[i] >= s.stop)"
    runs = f"transform({kept}, s -> struct(s.start AS start, 3 AS kind, s.stop AS stop, s.size AS size, s.found AS found))"
    return f"transform(array({both}), both -> transform(array({ends}), before -> transform(array(reverse({starts})), after -> {runs})[0])[0])[0]"


def with_spans(rows: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds ``base`` and ``spans`` (base and Markov spans)."""
    table = ",".join(f"{x:.6f}" for x in ratios)
    ratio = f"cast(split('{table}', ',') AS array<double>)"
    found = with_base_spans(rows).withColumn("runs", F.expr(matches(CANDIDATE, 3, found_text=True)))
    found = found.withColumn("candidates", F.expr(f"if(size(base) = 0 OR size(runs) = 0, runs, {apart()})")).drop("runs")
    judged = f"""filter(
        transform(candidates, s -> struct(s AS s, split(s.found, '') AS c)),
        x -> aggregate(sequence(1, x.s.size - 1), 0D, (t, i) -> t + element_at({ratio}, 128 * ascii(x.c[i - 1]) + ascii(x.c[i]) + 1)) >= greatest({MIN_RATIO}D, {MIN_RATIO_PER_CHAR}D * x.s.size))"""
    added = F.expr(f"transform({judged}, x -> struct(x.s.start AS start, x.s.kind AS kind, x.s.stop AS stop, x.s.size AS size))")
    return found.withColumn("spans", F.array_sort(F.concat("base", F.when(F.size("candidates") > 0, added).otherwise(F.expr(f"cast(array() AS {SPAN})"))))).drop("candidates")


def joined(spans: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', array({names})[s.kind], s.start, s.stop)), ',')")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans."""
    rows = text_rows(docs)
    found = with_spans(rows, train_ratios(rows))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) AS long)").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by ``[SECRET]`` and ``n_chars`` counted anew; null texts stay null."""
    ratios = train_ratios(text_rows(docs))
    found = with_spans(docs, ratios)
    # Code points a..b of the text, out of pieces of equal length: a substring of the whole text would be counted from its start.
    part = f"""array_join(transform(sequence(a div {PIECE}, (b - 1) div {PIECE}), k ->
        substring(pieces[k], greatest(a - k * {PIECE}, 0) + 1, least(b - k * {PIECE}, {PIECE}) - greatest(a - k * {PIECE}, 0))), '')"""
    between = lambda a, b: f"if({a} < {b}, transform(array(cast({a} AS int)), a -> transform(array(cast({b} AS int)), b -> {part})[0])[0], '')"
    mark = f"transform(spans, (s, i) -> if(s.start < done[i], '', concat({between('done[i]', 's.start')}, '{REDACTED}')))"
    tail = between("array_max(transform(spans, s -> s.stop))", "length(text)")
    whole = f"array_join(concat({mark}, array({tail})), '')"
    done = running("transform(spans, s -> s.stop)", "greatest(t, v)", "0")
    cut = F.expr(f"transform(array(regexp_extract_all(text, '(?s).{{1,{PIECE}}}', 0)), pieces -> transform(array({done}), done -> {whole})[0])[0]")
    clean = found.withColumn("text", F.when(F.col("text").isNotNull() & (F.size("spans") > 0), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)
