"""Personal data: overlapping candidate spans, boosted trees over their features, calibrated thresholds.

Built-in expressions only. Precise patterns give the base spans, which always
stay. Loose generators propose further spans: long numbers, local phone numbers,
spelled-out mail addresses and keys; they may overlap one another and the base.
Features describe a candidate's format and context. A rule that is precise but
misses much (a check digit, a country code, an assignment in front) labels the
candidates; the features leave out what that rule looks at. Candidates are
counted per combination of features over all documents, trees are boosted on
these counts, and for every kind the lowest score is taken from which enough of
the labelled candidates are positive, judged by a lower binomial bound. What the
rule itself labels is taken whatever its score, however few there are; the rule
for spelled-out mail addresses labels all of them.

A null text is empty and has no spans. Rows are judged one by one, whatever
their ids; an empty table gives no rows. ``spans`` ignores other columns,
``redacted`` keeps them. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.columns import let
from footfall.settings import materialize

BASE = ("email", "ip", "card", "phone")
ADDED = ("mail_words", "number", "local_phone", "secret")
KINDS = BASE + ADDED

# Fixed patterns of the base kinds. Quantifiers are possessive and starts are
# bound to the start of a run, so that no text takes more than linear time.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[ -]?+[0-9])++",
    "phone": "\\+[0-9](?:[ ().-]*+[0-9])++",
    "mail_words": "(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,}+ ?+(?:\\(at\\)|\\[at\\]|\\{at\\}) ?+[a-z0-9-]{2,}+"
    "(?: ?+(?:\\(dot\\)|\\[dot\\]|\\{dot\\}|\\.) ?+[a-z0-9-]{2,}+)++",
    "number": "(?<![0-9+.A-Za-z])[0-9](?:[ -]?+[0-9]){8,18}+(?![0-9])",
    "local_phone": "(?<![0-9+A-Za-z])\\(?+[0-9]{2,4}+\\)?+[ .-][0-9]{3,4}+[ .-][0-9]{3,4}+(?![0-9A-Za-z])",
    "secret": "(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+(?![A-Za-z0-9_/+-])",
}
# What a text must hold for a pattern to be worth running.
NEEDED = {
    "email": "@",
    "ip": "[0-9]\\.[0-9]",
    "card": "[0-9][ -]?[0-9]",
    "phone": "\\+[0-9]",
    "mail_words": "[(\\[{][aA][tT][)\\]}]",
    "number": "[0-9](?:[ -]?[0-9]){8}",
    "local_phone": "[0-9]\\)?[ .-][0-9]{3}",
    "secret": "[A-Za-z0-9_/+-]{20}",
}
CONTEXT = 24
# Trees, leaves' shrinkage, and the share of positives that a threshold must keep.
TREES = 24
RATE = 0.3
PRECISION = 0.9


def found(text: Column, kind: str) -> Column:
    """All matches as structs (s, e, t), in order; the lengths of what stands between them give the places."""
    pattern = F.lit(PATTERNS[kind])
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.from_json(F.lit("[]"), "array<struct<s:int,e:int,t:string>>")

    def placed(m: Column) -> Column:
        between = F.slice(F.split(text, PATTERNS[kind], -1), 1, F.size(m))
        start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

        def step(a: Column, x: Column) -> Column:
            s = a["at"] + F.length(x["gap"])
            return let(
                F.struct(s.alias("s"), (s + F.length(x["t"])).alias("e"), x["t"].alias("t")),
                lambda span: F.struct(span["e"].alias("at"), F.array_append(a["out"], span).alias("out")),
            )

        pairs = F.zip_with(between, m, lambda gap, t: F.struct(gap.alias("gap"), t.alias("t")))
        return F.aggregate(pairs, start, step, lambda a: a["out"])

    return F.when(
        text.rlike(NEEDED[kind]), let(matches, lambda m: F.when(F.size(m) == 0, empty).otherwise(placed(m)))
    ).otherwise(empty)


def digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def passes_check_digit(d: Column) -> Column:
    """Luhn's sum over a text of at most 19 digits."""

    def of(reverse: Column) -> Column:
        even = [F.substring(reverse, i + 1, 1).cast("int") for i in range(0, 19, 2)]
        # Doubled, and the digits of the double summed.
        odd = [F.translate(F.substring(reverse, i + 1, 1), "0123456789", "0246813579").cast("int") for i in range(1, 19, 2)]
        return sum(even + odd, F.lit(0)) % 10 == 0

    return let(F.rpad(F.reverse(d), 19, "0"), of)


def _valid(kind: str, t: Column) -> Column:
    if kind == "ip":
        return t.rlike("^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\\.|$)){4}$")
    if kind == "card":
        return let(digits(t), lambda d: F.length(d).between(13, 19) & passes_check_digit(F.substring(d, 1, 19)))
    if kind == "phone":
        return F.length(digits(t)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Structs (s, e) of the matches that are valid; those that fail are dropped."""
    valid = F.filter(found(text, kind), lambda x: _valid(kind, x["t"]))
    return F.transform(valid, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))


_FEATURES = "struct<s:int,e:int,label:boolean,length:int,digits:int,separators:int,mixed:int,before:int,cue:int>"
# Feature -> number of values. Their product bounds the cells of a kind.
FEATURES = {"length": 8, "digits": 8, "separators": 4, "mixed": 4, "before": 4, "cue": 2}


def _label(kind: str, t: Column, context: Column) -> Column:
    """A precise rule; the features leave out what it looks at."""
    if kind == "number":
        return let(digits(t), lambda d: F.length(d).between(13, 19) & passes_check_digit(F.substring(d, 1, 19)))
    if kind == "local_phone":
        return context.rlike("(?i)(?:\\+[0-9 ]{1,4}|\\b(?:tel|phone|call|fax|mobile)\\b.{0,8})$")
    if kind == "secret":
        return context.rlike("(?i)(?:token|secret|password|passwd|api.?key|access.?key)[\"']?\\s*[=:]\\s*[\"']?$")
    return F.lit(True)


def candidates(text: Column, kind: str) -> Column:
    """Structs of span, label and features of all candidates of an added kind."""

    def described(x: Column) -> Column:
        t = x["t"]
        context = F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))

        def features(c: Column) -> Column:
            letters = t.rlike("[A-Za-z]").cast("int") + 2 * t.rlike("[0-9]").cast("int")
            before = (
                F.when(c == "", 0)
                .when(c.rlike("[ \\x09-\\x0D]$"), 1)
                .when(c.rlike("[\"'=:(<]$"), 2)
                .otherwise(3)
            )
            cue = (
                F.lit(0)
                if kind in ("local_phone", "secret")  # their labels look at the words in front
                else c.rlike("(?i)\\b(?:card|visa|account|iban|ssn|tel|phone|mail|contact)\\b").cast("int")
            )
            return F.struct(
                x["s"].alias("s"),
                x["e"].alias("e"),
                _label(kind, t, c).alias("label"),
                F.least(F.lit(7), F.floor(F.length(t) / 6)).cast("int").alias("length"),
                F.least(F.lit(7), F.floor(F.length(digits(t)) / 3)).cast("int").alias("digits"),
                F.least(F.lit(3), F.length(F.regexp_replace(t, "[A-Za-z0-9]", ""))).cast("int").alias("separators"),
                letters.cast("int").alias("mixed"),
                (F.lit(0) if kind == "secret" else before).cast("int").alias("before"),
                cue.cast("int").alias("cue"),
            )

        return let(context, features)

    return F.transform(found(text, kind), described).cast(f"array<{_FEATURES}>")


Tree = tuple[str, int, tuple[str, int, float, float], tuple[str, int, float, float]]


@dataclass
class Model:
    """Boosted trees of two levels, and the score from which a candidate is taken."""

    start: float
    trees: list[Tree]
    threshold: float

    def score(self, cell: dict[str, int]) -> float:
        total = self.start
        for name, cut, low, high in self.trees:
            name, cut, below, above = low if cell[name] <= cut else high
            total += below if cell[name] <= cut else above
        return total

    def score_column(self, x: Column) -> Column:
        def leaf(side: tuple[str, int, float, float]) -> Column:
            name, cut, below, above = side
            return F.when(x[name] <= cut, F.lit(below)).otherwise(F.lit(above))

        total = F.lit(self.start)
        for name, cut, low, high in self.trees:
            total = total + F.when(x[name] <= cut, leaf(low)).otherwise(leaf(high))
        return total


def _split(cells, g, h):
    """The best cut of some cells by one feature, with Newton's values for both sides."""
    best = (-1.0, "length", 99, 0.0, 0.0)
    sum_g, sum_h = sum(g[i] for i, _ in cells), sum(h[i] for i, _ in cells)
    for name, values in FEATURES.items():
        for cut in range(values - 1):
            left = [i for i, c in cells if c[name] <= cut]
            a, b = sum(g[i] for i in left), sum(h[i] for i in left)
            gain = a * a / (b + 1) + (sum_g - a) ** 2 / (sum_h - b + 1)
            if gain > best[0] + 1e-12:
                best = (gain, name, cut, a / (b + 1), (sum_g - a) / (sum_h - b + 1))
    return best[1:]


def fit(counts: list[tuple[dict[str, int], int, int]]) -> Model | None:
    """Boosts trees on cells (features, candidates, positives); none when nothing is labelled."""
    total, positives = sum(n for _, n, _ in counts), sum(p for _, _, p in counts)
    if not positives:
        return None
    rate = min(max(positives / total, 1e-3), 1 - 1e-3)
    model = Model(math.log(rate / (1 - rate)), [], math.inf)
    scores = [model.start] * len(counts)
    cells = [(i, c) for i, (c, _, _) in enumerate(counts)]
    for _ in range(TREES):
        chance = [1 / (1 + math.exp(-s)) for s in scores]
        g = [p - n * q for (_, n, p), q in zip(counts, chance, strict=True)]
        h = [n * q * (1 - q) for (_, n, _), q in zip(counts, chance, strict=True)]
        name, cut, _, _ = _split(cells, g, h)
        sides = []
        for part in ([x for x in cells if x[1][name] <= cut], [x for x in cells if x[1][name] > cut]):
            feature, at, below, above = _split(part, g, h)
            sides.append((feature, at, RATE * below, RATE * above))
        model.trees.append((name, cut, *sides))
        scores = [model.score(c) for c, _, _ in counts]
    _calibrate(model, counts, scores)
    return model


def _calibrate(model: Model, counts, scores) -> None:
    """The lowest score at which the positives' share, by Wilson's lower bound, is still enough."""
    order = sorted(range(len(counts)), key=lambda i: -scores[i])
    n = p = 0
    for k, i in enumerate(order):
        n, p = n + counts[i][1], p + counts[i][2]
        last = k + 1 == len(order) or scores[order[k + 1]] < scores[i] - 1e-9
        if last and n and _lower_bound(p, n) >= PRECISION:
            model.threshold = scores[i] - 1e-9


def _lower_bound(p: int, n: int, z: float = 1.645) -> float:
    share = p / n
    return (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def train(docs: DataFrame, text: str = "text") -> dict[str, Model | None]:
    """A model for each added kind, from the counts of all documents' candidates."""
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def named(kind: str) -> Column:
        return F.transform(candidates(plain, kind), lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("x")))

    proposed = docs.select(F.explode(F.flatten(F.array(*map(named, ADDED)))).alias("c"))
    names = list(FEATURES)
    counts = materialize(
        proposed.select("c.kind", "c.x.*")
        .groupBy("kind", *names)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("p")),
        "cells",
    )
    by_kind: dict[str, list] = {k: [] for k in ADDED}
    for r in counts.orderBy("kind", *names).collect():
        by_kind[r.kind].append(({name: r[name] for name in names}, r.n, r.p))
    return {k: fit(cells) for k, cells in by_kind.items()}


def all_spans(text: Column, models: dict[str, Model | None]) -> dict[str, Column]:
    """Kind -> structs (s, e) of the spans that are taken: what the precise rule labels, and what scores high enough."""

    def taken(kind: str, model: Model | None) -> Column:
        def chosen(x: Column) -> Column:
            if model is None or model.threshold == math.inf:
                return x["label"]
            return x["label"] | (model.score_column(x) >= model.threshold)

        return F.transform(
            F.filter(candidates(text, kind), chosen), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
        )

    return {k: base_spans(text, k) for k in BASE} | {k: taken(k, m) for k, m in models.items()}


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(
        spans, lambda x: F.concat(F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))
    )


def spans(docs: DataFrame, models: dict[str, Model | None] | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    models = train(docs) if models is None else models
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    taken = all_spans(plain, models)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(f"_{k}") for k, c in taken.items()])
    base = F.array_join(F.concat(*[_listed(k, F.col(f"_{k}")) for k in BASE]), ",")
    every = F.array_join(F.concat(*[_listed(k, F.col(f"_{k}")) for k in taken]), ",")
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(base, 256).alias("base_sha256"),
        every.alias("spans"),
    )


def redacted(docs: DataFrame, models: dict[str, Model | None] | None = None, text: str = "text") -> DataFrame:
    """The rows with every span replaced by its kind in brackets; spans that overlap become one."""
    models = train(docs, text) if models is None else models
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    taken = all_spans(plain, models)

    def marks(kind: str) -> Column:
        mark = F.lit(f"[{kind.upper()}]").alias("m")
        return F.transform(taken[kind], lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), mark))

    marked = F.array_sort(F.concat(*map(marks, taken)))

    def replaced(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(a: Column, x: Column) -> Column:
            end = -x["e"]
            # A span that begins inside the last one goes with it.
            return F.when(
                x["s"] >= a["at"],
                F.struct(
                    end.alias("at"),
                    F.concat(a["out"], F.substring(plain, a["at"] + 1, x["s"] - a["at"]), x["m"]).alias("out"),
                ),
            ).otherwise(F.struct(F.greatest(a["at"], end).alias("at"), a["out"].alias("out")))

        return F.when(F.size(found) == 0, F.col(text)).otherwise(
            F.aggregate(
                found, start, step, lambda a: F.concat(a["out"], F.substring(plain, a["at"] + 1, F.length(plain)))
            )
        )

    return docs.withColumn(text, let(marked, replaced))
