"""Personal data by weak supervision, in DataFrame functions only.

Fixed patterns give the base spans (email, ip, card, phone). Wider patterns give candidates beyond them: numbers written
otherwise, tokens around an @, long mixed keys. Five labelers vote yes, no or nothing on every candidate: its shape, its
check digit, a gazetteer, the words around it, and whether the document holds base spans. Expectation-maximisation on the
counts of vote patterns (a table of fixed size: kinds x 3^5 votes x length classes) estimates each labeler's reliability
and the candidates' posteriors; a logistic span classifier is trained on those posteriors and scores the candidates as a
column expression. Spans above one half join the base spans. Every document is read whole, twice; nothing is shuffled but
the pattern counts.

How positions are found: ``split`` by a pattern gives the text between matches, ``regexp_extract_all`` the matches, and
their lengths add up to positions in code points. Java's matcher recurses on repeated groups, which very long texts would
overflow; so separators that stand between two digits (dots between two domain characters) are first marked by one
private character, and every pattern is a run of one character class. A run is tried from its first place only, and matches
are put together in blocks, so finding them takes time in proportion to the text. Candidates are held against the base spans of their document pair by
pair.

Cases: a null or empty text has no spans; numbers of any length are consumed whole; repeated ids and null ids are scored
row by row; without any candidate the classifier adds nothing; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outagegrid.llm.common import text_or_empty

MARK = chr(0xE000)  # stands for a separator between two digits, or a dot between two domain characters
UNMARKED = chr(0xA4)  # what that character becomes where a text holds it already: of no class that a pattern uses
KINDS = ["email", "ip", "card", "phone"]
# The gazetteers.
DOMAINS = "com org net edu gov int info io de fr es it uk eu ch at be nl"
KEY_PREFIXES = "sk pk ghp gho akia xoxb xoxp aiza eyj"
AROUND = (
    "phone tel call mobile fax cell contact whatsapp mail email card visa credit account iban ssn password secret token "
    "key api telefon nummer handy konto téléphone numéro appel carte teléfono número tarjeta cuenta"
)
LABELERS = ["shape", "check", "gazetteer", "context", "company"]


SPAN = "struct<start:int,end:int,match:string,before:string,after:string>"


BLOCK = 64


def _zipped(pieces: Column, found: Column) -> Column:
    """array of (gap, match, next gap)."""
    return F.arrays_zip(
        F.slice(pieces, 1, F.size(found)).alias("gap"), found.alias("match"), F.slice(pieces, 2, F.size(found)).alias("next")
    )


def _blocks(zipped: Column) -> Column:
    """The same in blocks: what is appended to an array is copied with it, so arrays stay short."""
    numbers = F.sequence(F.lit(0), F.ceil(F.size(zipped) / BLOCK).cast("int") - 1)
    return F.when(F.size(zipped) > 0, F.transform(numbers, lambda b: F.slice(zipped, b * BLOCK + 1, BLOCK)))


def _lengths(blocks: Column) -> Column:
    return F.transform(
        blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + F.length(p["gap"]) + F.length(p["match"]))
    )


def _matches(blocks: Column, lengths: Column, context: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places: array of (start, end, match, before, after), the last two up to
    ``context`` code points long."""
    none = F.array().cast(f"array<{SPAN}>")

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        before = F.right(part["gap"], F.lit(context)) if context else F.lit("")
        after = F.left(part["next"], F.lit(context)) if context else F.lit("")
        one = F.struct(
            start.alias("start"), end.alias("end"), part["match"].alias("match"), before.alias("before"), after.alias("after")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one.cast(SPAN))).alias("out"))

    def placed(block: Column, k: Column) -> Column:
        before = F.aggregate(F.slice(lengths, F.lit(1), k), F.lit(0), lambda n, x: n + x)
        return F.aggregate(block, F.struct(before.alias("at"), none.alias("out")), add, lambda s: s["out"])

    return F.flatten(F.transform(blocks, placed))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, i, F.lit(1))) - 48
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _byte(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return F.when(F.length(short) > 3, False).otherwise(F.try_to_number(short, F.lit("999")) <= 255)


def _marked_digits(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, MARK, UNMARKED), "(?<=[0-9])[ -](?=[0-9])", MARK)


def _marked_dots(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, MARK, UNMARKED), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)


def _run(chars: str) -> str:
    """A whole run of a class, tried where it starts or where the last match ended: never again from every place inside, so
    a search stays linear in the text."""
    return rf"(?:\G|(?<![{chars}]))[{chars}]++"


#: Name: (column to search, pattern, column that says whether a match is possible, context kept).
PATTERNS = {
    "email": ("dotted", _run(f"A-Za-z0-9._%+{MARK}-") + f"@[A-Za-z0-9-]+{MARK}[A-Za-z0-9{MARK}-]*", "has_at", 0),
    "ip": ("t", _run("0-9") + r"\.[0-9]++\.[0-9]++\.[0-9]+", "has_digit", 0),
    "card": ("digits", f"[0-9][0-9{MARK}]+", "has_digit", 0),
    "phone": ("t", r"\+[0-9][\x20().0-9-]+[0-9]", "has_plus", 0),
    "number": ("digits", rf"(?<![\p{{L}}0-9])[+(]?[0-9][0-9{MARK}()./]+[0-9](?![\p{{L}}0-9])", "has_digit", 32),
    "at": ("t", r"(?:\G|(?<=[\x09-\x0D\x20@<>]))[^\x09-\x0D\x20@<>]++@[^\x09-\x0D\x20@<>]+", "has_at", 32),
    "key": ("t", r"[A-Za-z0-9_]{16,}", "has_long", 32),
}


def _matched(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, and for each pattern an array of its matches; every step is a projection of its own, so that no
    search is planned twice."""
    t = F.col("t")
    digit = t.rlike("[0-9]")
    df = docs.select(*keep, text_or_empty().alias("t")).withColumns({
        "has_at": F.contains(t, F.lit("@")), "has_digit": digit, "has_plus": digit & F.contains(t, F.lit("+")),
        "has_long": t.rlike("[A-Za-z0-9_]{16}"),
    })
    df = df.withColumns({
        "dotted": F.when(F.col("has_at"), _marked_dots(t)), "digits": F.when(F.col("has_digit"), _marked_digits(t)),
    })
    searched = {}
    for name, (column, pattern, possible, _) in PATTERNS.items():
        searched[f"gaps_{name}"] = F.when(F.col(possible), F.split(F.col(column), pattern, -1))
        searched[f"found_{name}"] = F.when(
            F.col(possible), F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0))
        )
    df = df.select(*keep, *[c.alias(k) for k, c in searched.items()])
    none = F.array().cast(f"array<{SPAN}>")
    df = df.select(*keep, *[_zipped(F.col(f"gaps_{k}"), F.col(f"found_{k}")).alias(f"zipped_{k}") for k in PATTERNS])
    df = df.select(*keep, *[_blocks(F.col(f"zipped_{k}")).alias(f"blocks_{k}") for k in PATTERNS])
    df = df.select("*", *[_lengths(F.col(f"blocks_{k}")).alias(f"lengths_{k}") for k in PATTERNS])
    return df.select(
        *keep,
        *[
            F.coalesce(_matches(F.col(f"blocks_{k}"), F.col(f"lengths_{k}"), context), none).alias(k)
            for k, (_, _, _, context) in PATTERNS.items()
        ],
    )


def _base_spans() -> Column:
    """array of (start, rank of the kind, kind, end), ordered, from the columns of ``_matched``."""
    found = {
        "email": F.col("email"),
        "ip": F.filter("ip", lambda m: F.forall(F.split(m["match"], r"\."), _byte)),
        "card": F.filter(
            "card",
            lambda m: F.when(F.length(_digits(m["match"])).between(14, 19), _luhn(_digits(m["match"]))).otherwise(False),
        ),
        "phone": F.filter("phone", lambda m: F.length(_digits(m["match"])).between(10, 15)),
    }

    def spans(kind: str) -> Column:
        return F.transform(
            found[kind],
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")
            ),
        )

    return F.array_sort(F.concat(*[spans(k) for k in KINDS]))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), 1).when(F.coalesce(no, F.lit(False)), -1).otherwise(0)


def _candidates(base: Column) -> Column:
    """array of (start, end, kind, votes..., size): what the wider patterns find outside the base spans."""
    company = F.size(base) > 0
    around = r"(?i)(?<![\p{L}])(?:" + "|".join(AROUND.split()) + r")(?![\p{L}])"

    def listed(kind: Column, found: Column, shape, check, gazetteer) -> Column:
        def one(m: Column) -> Column:
            context = F.concat_ws(" ", m["before"], m["after"]).rlike(around)
            return F.struct(
                m["start"].alias("start"), m["end"].alias("end"), kind(m).alias("kind"), shape(m).alias("shape"),
                check(m).alias("check"), gazetteer(m).alias("gazetteer"), _vote(context, F.lit(False)).alias("context"),
                _vote(company, ~company).alias("company"),
                F.least(F.floor(F.length(m["match"]) / 4), F.lit(8)).cast("int").alias("size"),
            )

        free = F.filter(found, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"])))
        return F.transform(free, one)

    n = lambda m: F.length(_digits(m["match"]))
    numbers = F.filter("number", lambda m: n(m).between(7, 19))
    grouped = rf"^[+]?(?:\(?[0-9]{{2,4}}\)?[{MARK}. /)]){{1,3}}[0-9]{{3,5}}$"
    date = rf"^(?:19|20)[0-9]{{2}}[{MARK}./][0-9]{{1,2}}[{MARK}./][0-9]{{1,2}}$"
    ats = F.filter("at", lambda m: F.length(m["match"]) <= 254)
    keys = F.filter(
        "key",
        lambda m: F.length(m["match"]).between(16, 128) & m["match"].rlike("[0-9]") & m["match"].rlike("[A-Za-z]"),
    )
    last = lambda m: F.lower(F.regexp_extract(m["match"], r"\.([A-Za-z]+)[.,;:!?)]*$", 1))
    return F.concat(
        listed(
            lambda m: F.when(n(m) <= 13, F.lit("phone")).otherwise(F.lit("card")), numbers,
            lambda m: _vote(m["match"].rlike(grouped) & ~m["match"].rlike(date), m["match"].rlike(date)),
            lambda m: F.when(n(m).between(13, 19), F.when(_luhn(_digits(m["match"])), 1).otherwise(-1)).otherwise(0),
            lambda m: _vote(m["match"].rlike(r"^[+(]"), m["match"].rlike(r"[/]")),
        ),
        listed(
            lambda m: F.lit("email"), ats,
            lambda m: _vote(m["match"].rlike(r"^[\p{L}0-9._%+-]+@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+){1,8}"), ~m["match"].rlike(r"@.*\.")),
            lambda m: F.lit(0), lambda m: _vote(last(m).isin(DOMAINS.split()), ~last(m).isin(DOMAINS.split())),
        ),
        listed(
            lambda m: F.lit("secret"), keys, lambda m: _vote(m["match"].rlike("^[0-9a-f]{16,}$"), m["match"].rlike("_[a-z]+_")),
            lambda m: F.lit(0),
            lambda m: _vote(m["match"].rlike("(?i)^(?:" + "|".join(KEY_PREFIXES.split()) + ")[_0-9]"), F.lit(False)),
        ),
    )


def estimate(patterns: list[dict], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Dawid-Skene on counted vote patterns of one kind: (posterior of every pattern, reliability table labeler x truth x
    vote). The start is the majority vote; rows of the table are smoothed by one pseudo-vote."""
    votes = np.array([[p[name] for name in LABELERS] for p in patterns]) + 1
    count = np.array([p["n"] for p in patterns], dtype=float)
    belief = 1 / (1 + np.exp(-(votes - 1).sum(axis=1)))
    table = np.zeros((len(LABELERS), 2, 3))
    for _ in range(rounds):
        prior = ((belief * count).sum() + 1) / (count.sum() + 2)
        for k in range(len(LABELERS)):
            for truth, weight in enumerate((1 - belief, belief)):
                table[k, truth] = np.bincount(votes[:, k], weights=weight * count, minlength=3) + 1 / 3
        table /= table.sum(axis=2, keepdims=True)
        log = np.log(np.array([1 - prior, prior]))[None, :] + sum(
            np.log(table[k][:, votes[:, k]]).T for k in range(len(LABELERS))
        )
        belief = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))
    return belief, table


def _features(row: dict) -> list[str]:
    return [f"kind={row['kind']}", f"size={row['kind']}{row['size']}"] + [f"{c}={row[c]}" for c in LABELERS]


def train(docs: DataFrame) -> dict[str, float]:
    """Weights of the span classifier by feature name, "" for the bias; empty without candidates. One job, whose result
    is a table of at most kinds x 3^5 x 9 rows."""
    rows = (
        _matched(docs, []).withColumn("base", _base_spans()).select(F.explode(_candidates(F.col("base"))).alias("c"))
        .groupBy("c.kind", *[f"c.{x}" for x in LABELERS], "c.size").agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    patterns = sorted((r.asDict() for r in rows), key=lambda r: (r["kind"], *[r[c] for c in LABELERS], r["size"]))
    if not patterns:
        return {}
    belief = np.zeros(len(patterns))
    for kind in sorted({p["kind"] for p in patterns}):
        at = [i for i, p in enumerate(patterns) if p["kind"] == kind]
        belief[at] = estimate([patterns[i] for i in at])[0]
    names = sorted({f for p in patterns for f in _features(p)})
    x = np.array([[1.0] + [float(f in set(_features(p))) for f in names] for p in patterns])
    count = np.array([p["n"] for p in patterns], dtype=float)
    share = count / count.sum()
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps on the ridge logistic loss
        y = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ ((y - belief) * share) + 1e-4 * w
        hess = (x * (share * np.maximum(y * (1 - y), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return dict(zip(["", *names], (round(float(v), 9) for v in w), strict=True))


def _probability(candidate: Column, weights: dict[str, float]) -> Column:
    z = F.lit(weights[""])
    for name, weight in weights.items():
        column, _, value = name.partition("=")
        if column in LABELERS:
            z = z + F.when(candidate[column] == int(value), weight).otherwise(0.0)
        elif column == "kind":
            z = z + F.when(candidate["kind"] == value, weight).otherwise(0.0)
        elif column == "size":
            z = z + F.when(F.concat(candidate["kind"], candidate["size"].cast("string")) == value, weight).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, base, added: arrays of (start, rank, kind, end) in code points, ends exclusive."""
    weights = train(docs)
    rows = _matched(docs, ["doc_id"]).withColumns({"doc_id": F.col("doc_id").cast("long"), "base": _base_spans()})
    if not weights:
        return rows.select("doc_id", "base", F.slice("base", 1, 0).alias("added"))
    rows = rows.withColumn("candidates", _candidates(F.col("base")))
    wanted = F.filter("candidates", lambda c: _probability(c, weights) >= least)
    rank = lambda kind: F.coalesce(
        F.nullif(F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind), F.lit(0)) - 1, F.lit(len(KINDS))
    ).cast("int")
    added = F.transform(
        wanted,
        lambda c: F.struct(c["start"].alias("start"), rank(c["kind"]).alias("rank"), c["kind"].alias("kind"), c["end"].alias("end")),
    )
    return rows.select("doc_id", "base", F.array_distinct(added).alias("added"))


def joined(spans: Column) -> Column:
    """kind:start:end of spans by start, then kind, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
