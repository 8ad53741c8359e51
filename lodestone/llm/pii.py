"""PII by candidate gradient boosting (operator 3), DataFrame functions only.

*Base.* Emails, IPv4 addresses, payment cards and international phone numbers
by fixed patterns and checks; these spans always stay.

*Candidates.* Per kind, looser patterns propose spans that may overlap: written
out or bracketed email addresses, IPv6 and dotted quads, 13-19 digit numbers
under any separators, phone numbers without a plus.  Each candidate has format
features (digits, groups, separators, check digit, ...) and context features
(label words on its left, neighbouring characters).  Boosted trees score them
and the calibrated score decides: per kind the lowest threshold that reaches
``precision`` on rows of their own selects spans.  A kind without enough
positives there selects nothing.

*Training rows.* Generated values of each kind (and of things that look like
them: dates, versions, part numbers, hex dumps, failing check digits) in the
sentences of PHRASES, labelled by what they were generated as.  Neither the
patterns of the base nor the features' word lists take part in the labels, and
most sentences hold none of those words.  Rows go to three folds: trees are
fitted on the first, scores are calibrated on the second, thresholds chosen on
the third.  The rows do not depend on the table, so the model is the same at
every size; it is fitted on the driver and scored as a column expression.

Texts are read once, whole; spans are code points, end exclusive.  Positions
come from the pieces between matches, so nothing is rescanned.  The patterns
start only where a match can begin and never give back what they took, which
keeps them linear in texts of any shape.

Cases: null text is empty (no spans).  Repeated rows are documents of their
own.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import boosting
from lodestone.llm.scratch import materialise

KINDS = ("email", "ip", "card", "phone")
#: examples of each sentence
EACH = 24
PRECISION = 0.9
#: a threshold needs so many held-out positives at least
LEAST = 10
LEFT, RIGHT = 28, 12

_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    # a local part starts where none could start before, or right after the last match
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole run of digits with single separators, 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]*[\x20().0-9-][0-9]",
}
# two card numbers side by side are one run of digits: groups of four are candidates of their own
GROUPED = r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}+(?![0-9])"
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+\s?[\[(]\s?(?:at|AT)\s?[\])]\s?[A-Za-z0-9-]{{1,63}}+(?:\s?(?:[\[(]\s?(?:dot|DOT)\s?[\])]|\.)\s?[A-Za-z0-9-]{{1,24}}+){{1,4}}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{1,4}+:){7}[0-9A-Fa-f]{1,4}+|[0-9]{1,4}+\.[0-9]{1,4}+\.[0-9]{1,4}+\.[0-9]{1,4}+)(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}+\)?(?:[\x20./-]{1,2}+\(?[0-9]{2,4}+\)?){2,4}+(?![0-9])",
}
# the text must hold this for a pattern to be worth a scan
NEEDS = {"email": "@", "phone": "+"}
WORDS = {
    "email": "email|e-mail|mail|contact|write|courriel|correo|adresse",
    "ip": "ip|host|server|address|client|login|logged|from",
    "card": "card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta|cc",
    "phone": "phone|tel|call|mobile|fax|cell|whatsapp|telefon|téléphone|teléfono|ring",
    "other": "order|invoice|id|ref|no|number|version|page|isbn|sku|date|build|serial|part|issue|section|room|score|chapter|v",
}
FEATURES = [
    *(f"is_{k}" for k in KINDS), "digits", "chars", "groups", "longest", "seps", "luhn", "octets", "same", "first", "paren", "plus", "dots",
    *(f"near_{k}" for k in WORDS), "prev_alnum", "next_alnum", "prev_plus",
]

CAND = "array<struct<kind:string,start:int,end:int,match:string,left:string,right:string>>"


def located(text: Column, pattern: str, kind: str, needs: str | None = None) -> Column:
    """Matches of a pattern with code-point spans and context, in order."""
    parts = F.struct(F.split(text, pattern, -1).alias("s"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))

    def walk(x: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            start = acc["pos"] + F.length(x["s"][k])
            end = start + F.length(x["m"][k])
            one = F.struct(
                F.lit(kind).alias("kind"),
                start.alias("start"),
                end.alias("end"),
                x["m"][k].alias("match"),
                F.right(x["s"][k], F.lit(LEFT)).alias("left"),
                F.left(x["s"][k + 1], F.lit(RIGHT)).alias("right"),
            )
            return F.struct(end.alias("pos"), F.array_append(acc["out"], one).alias("out"))

        start = F.struct(F.lit(0).alias("pos"), F.array().cast(CAND).alias("out"))
        found = F.aggregate(F.sequence(F.lit(0), F.size(x["m"]) - 1), start, step, lambda acc: acc["out"])
        return F.when(F.size(x["m"]) > 0, found).otherwise(F.array().cast(CAND))

    out = F.transform(F.array(parts), walk)[0]
    return F.when(F.contains(text, F.lit(needs)), out).otherwise(F.array().cast(CAND)) if needs else out


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _octets(m: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    return F.forall(F.split(m, r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.regexp_replace(p, "[^0-9]", "").try_cast("decimal(38,0)"), F.lit(999)) <= 255))


def valid(kind: str, m: Column) -> Column:
    """The checks that a base match must pass."""
    n = F.length(_digits(m))
    return {
        "email": F.lit(True),
        "ip": _octets(m),
        "card": n.between(16, 19) & luhn(_digits(m)),
        "phone": n.between(8, 15),
    }[kind]


def _spans(text: Column) -> tuple[Column, Column]:
    """(valid base spans, loose candidates) of a text."""
    # a lambda's second parameter would be the index, so the kind comes by closure
    checked = lambda k: lambda c: valid(k, c["match"])
    base = [F.filter(located(text, BASE[k], k, NEEDS.get(k)), checked(k)) for k in KINDS]
    loose = {k: located(text, LOOSE[k], k) for k in KINDS}
    written = F.rlike(text, F.lit(r"[\[(]\s?(?:at|AT)\s?[\])]"))
    loose["grouped"] = located(text, GROUPED, "card")
    loose["email"] = F.when(written, loose["email"]).otherwise(F.array().cast(CAND))
    return F.concat(*base), F.concat(*loose.values())


def features(c: Column) -> dict[str, Column]:
    """Features of one candidate struct, as doubles."""
    m, left, right = c["match"], F.lower(c["left"]), c["right"]
    digits = _digits(m)
    groups = F.regexp_extract_all(m, F.lit("[0-9A-Za-z]+"), F.lit(0))
    out = {f"is_{k}": c["kind"] == k for k in KINDS}
    out |= {
        "digits": F.length(digits),
        "chars": F.length(m),
        "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "seps": F.size(F.array_distinct(F.regexp_extract_all(m, F.lit("[^0-9A-Za-z]"), F.lit(0)))),
        "luhn": (F.length(digits) >= 13) & luhn(digits),
        "octets": F.regexp_like(m, F.lit(r"^[0-9.]+$")) & _octets(m),
        "same": F.size(F.array_distinct(F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0)))),
        "first": F.coalesce(F.left(digits, F.lit(1)).try_cast("int"), F.lit(-1)),
        "paren": F.contains(m, F.lit("(")),
        "plus": F.startswith(m, F.lit("+")),
        "dots": F.length(m) - F.length(F.replace(m, F.lit("."), F.lit(""))),
        "prev_alnum": F.regexp_like(left, F.lit(r"[\p{L}\p{N}]$")),
        "next_alnum": F.regexp_like(right, F.lit(r"^[\p{L}\p{N}]")),
        "prev_plus": F.regexp_like(left, F.lit(r"\+[0-9]{1,3}[ .(-]{0,3}$")),
    }
    # label words count only close by: within the last three words
    out |= {f"near_{k}": F.regexp_like(left, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?:{w})(?![\p{{L}}\p{{N}}])\W*(?:[\p{{L}}]+\W+)?$")) for k, w in WORDS.items()}
    return {k: out[k].cast("double") for k in FEATURES}


#: sentences around a value: (kind, what the value is, sentence)
PHRASES = (
    ("email", "email", "You can reach the treasurer under {} until Friday."),
    ("email", "email", "Send the signed form to {} please"),
    ("email", "email", "Questions? {} answers within a day"),
    ("email", "email", "email: {} (office hours only)"),
    ("email", "email", "joe's new address {} works again"),
    ("email", "email", "{}"),
    ("email", "aside", "The gates open {} and close at dusk"),
    ("email", "aside", "shares were sold {} yesterday"),
    ("email", "aside", "look {} again"),
    ("ip", "ip6", "The attacker came from {} at night"),
    ("ip", "ip6", "ping {} shows no loss"),
    ("ip", "ip6", "server {} is down"),
    ("ip", "ip6", "she connected through {} twice"),
    ("ip", "hex", "the dump reads {} there"),
    ("ip", "hex", "checksum {} ok"),
    ("ip", "quad", "chapter {} of the manual"),
    ("ip", "quad", "measured {} in the lab"),
    ("ip", "quad", "the address {} does not exist"),
    ("card", "card", "He paid with {} and left"),
    ("card", "card", "charge it to {} (Ms. Lee)"),
    ("card", "card", "my visa {} expires in May"),
    ("card", "card", "old plastic: {}, new one follows"),
    ("card", "card", "{}"),
    ("card", "number", "parcel {} is on its way"),
    ("card", "number", "the card catalogue lists {} as missing"),
    ("card", "number", "order {} was cancelled"),
    ("card", "number", "meter reading {} kWh"),
    ("card", "stamp", "log entry {} repeated"),
    ("card", "stamp", "taken on {} in Rome"),
    ("phone", "phone", "Ring me on {} after six"),
    ("phone", "phone", "You get the front desk under {} all day"),
    ("phone", "phone", "tel {} or knock"),
    ("phone", "phone", "Her mobile, {}, is off"),
    ("phone", "phone", "ask for Bob, {}, any time"),
    ("phone", "phone", "phone number {} (landline)"),
    ("phone", "part", "part {} fits the older model"),
    ("phone", "part", "invoice {} is overdue"),
    ("phone", "part", "ISBN {} is out of print"),
    ("phone", "part", "we counted {} birds"),
    ("phone", "date", "born {} in Lyon"),
    ("phone", "date", "call the meeting of {} to order"),
    ("phone", "date", "from {} on"),
)
PERSONAL = ("email", "ip6", "card", "phone")


def value(what: str, r: random.Random) -> str:
    """A random value of what a sentence asks for."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    name = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(3, 9)))

    def card(n: int, good: bool) -> str:
        body = r.choice("3456") + d(n - 2)
        total = sum(x if i % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(body))))
        digit = (10 - total % 10) % 10
        body += str(digit if good else (digit + r.randint(1, 9)) % 10)
        sep = r.choice(["", "", " ", "-", ".", "  "])
        return sep.join(body[i : i + 4] for i in range(0, n, 4))

    a, b, c = d(3), d(3), d(4)
    return {
        "email": lambda: f"{name()}{r.choice(['', '.' + name(), d(2)])}{r.choice([' [at] ', '(at)', '[at]', ' (AT) '])}{name()}{r.choice([' [dot] ', '.', '(dot)'])}{r.choice(['com', 'org', 'net', 'de'])}",
        "aside": lambda: f"{r.choice(['[at]', '(at)', '[ at ]'])} {r.choice([d(2), name(), name() + ' .  ' + name(), d(1) + '.' + d(2)])}",
        "ip6": lambda: ":".join(f"{r.randrange(65536):x}" for _ in range(8)),
        "hex": lambda: ":".join(d(2) if r.random() < 0.5 else f"{r.randrange(256):02x}" for _ in range(8)),
        "quad": lambda: f"{r.randrange(256, 1999)}.{d(2)}.{d(1)}.{d(r.randint(1, 4))}",
        "card": lambda: card(r.choice([14, 15, 15, 16, 16, 16, 19]), True),
        "number": lambda: card(r.randint(13, 18), r.random() < 0.1) if r.random() < 0.7 else r.choice("0129") + d(r.randint(12, 17)),
        "stamp": lambda: f"20{d(2)}{r.choice(['', '-', '.'])}0{r.randint(1, 9)}{r.choice(['', '-', '.'])}{r.randint(10, 28)} {r.randint(10, 23)} {d(2)} {d(2)} {d(3)}",
        "phone": lambda: r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{d(2)} {d(4)} {d(4)}", f"0{d(3)}/{d(3)} {d(2)} {d(2)}"]),
        "part": lambda: r.choice([f"{a}-{b}-{c}", f"{d(2)}.{d(3)}.{d(3)}", f"{a} {b} {c}", f"97{d(1)}-{d(2)}-{d(4)}-{d(3)}", f"{d(2)} {d(3)} {d(3)}", f"{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(256)}"]),
        "date": lambda: r.choice([f"{r.randint(10, 31)}.{r.randint(10, 12)}.{r.randint(1900, 2030)}", f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 31)}", f"{r.randint(10, 31)}/{r.randint(10, 12)}/{r.randint(1900, 2030)} {r.randint(10, 23)}"]),
    }[what]()


def examples(phrases=PHRASES, each: int = EACH, seed: int = 3) -> list[tuple[str, str, int, int, int]]:
    """Labelled texts: (kind, text, 1 if the value is personal data, its start and end)."""
    r = random.Random(seed)
    out = []
    for _ in range(each):
        for kind, what, phrase in phrases:
            head = " ".join("".join(r.choice("aeiounrstl") for _ in range(r.randint(2, 8))) for _ in range(r.randint(0, 5)))
            before, after = phrase.split("{}")
            x = value(what, r)
            start = f"{head} {before}" if head else before
            out.append((kind, start + x + after, int(what in PERSONAL), len(start), len(start) + len(x)))
    return out


def _matrix(rows) -> tuple[list[str], np.ndarray]:
    return [r["kind"] for r in rows], np.array([[r[f] for f in FEATURES] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))


def labelled(spark, rows: list[tuple[str, str, int, int, int]]) -> list:
    """Features, kind and label of the candidates of each example's kind that cover most of its value."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, text string, label int, a int, b int")
    _, loose = _spans(F.col("text"))
    found = frame.select("i", "k", "label", "a", "b", F.explode(loose).alias("c")).where("k = c.kind")
    found = found.where((F.least("b", F.col("c.end")) - F.greatest("a", F.col("c.start"))) * 2 > F.col("b") - F.col("a"))
    return sorted(found.select("i", "label", F.col("c.kind").alias("kind"), F.col("c.start").alias("start"), *[v.alias(k) for k, v in features(F.col("c")).items()]).collect(), key=lambda r: (r["i"], r["start"]))


def fit(spark, precision: float = PRECISION, phrases=PHRASES, each: int = EACH) -> tuple[boosting.Trees, dict[str, float]]:
    """Trees and thresholds from generated examples; a row count that is fixed by phrases and each."""
    rows = labelled(spark, examples(phrases, each))
    kinds, x = _matrix(rows)
    y = np.array([r["label"] for r in rows], dtype=int)
    # whole rounds of sentences go to one fold
    fold = np.array([r["i"] // len(phrases) % 4 for r in rows])
    model = boosting.fit(x, y, FEATURES, calibrate=fold == 2, leave=fold == 3)
    held = fold == 3
    p = model.probability(x[held])
    limits = {}
    for k in KINDS:
        mine = np.array([a == k for a, h in zip(kinds, held, strict=True) if h], bool)
        s, t = p[mine], y[held][mine]
        order = np.argsort(-s, kind="stable")
        s, t = s[order], t[order]
        good = np.cumsum(t) / np.arange(1, len(t) + 1)
        # equal scores stand or fall together
        last = np.append(s[1:] != s[:-1], True) if len(s) else np.zeros(0, bool)
        ok = np.flatnonzero((good >= precision) & (np.cumsum(t) >= LEAST) & last)
        limits[k] = float(s[ok[-1]]) if len(ok) else 2.0
    return model, limits


def _selected(model: boosting.Trees, limits: dict[str, float]) -> Column:
    """Method spans: candidates over their threshold that touch no base span, leftmost-longest, none overlapping."""
    limit = lambda c: F.coalesce(*[F.when(c["kind"] == k, F.lit(v)) for k, v in limits.items()])
    free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    # features once per candidate, then the trees on plain numbers
    told = F.transform(F.filter("loose", free), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), F.struct(*[v.alias(k) for k, v in features(c).items()]).alias("f")))
    scored = F.filter(told, lambda c: model.expression({k: c["f"][k] for k in FEATURES}) >= limit(c))
    ranked = F.array_sort(F.transform(scored, lambda c: F.struct(c["start"].alias("start"), (-c["end"]).alias("less"), c["end"].alias("end"), c["kind"].alias("kind"))))
    kept = F.aggregate(
        ranked,
        F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("out")),
        lambda a, c: F.when(c["start"] >= a["pos"], F.struct(c["end"].alias("pos"), F.array_append(a["out"], F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))).alias("out"))).otherwise(a),
        lambda a: a["out"],
    )
    return kept


def _text(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    order = lambda c: F.coalesce(*[F.when(c["kind"] == k, F.lit(i)) for i, k in enumerate(KINDS)])
    ranked = F.array_sort(F.transform(spans, lambda c: F.struct(order(c).alias("o"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    return F.array_join(F.transform(ranked, lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))), ",")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, base, loose): valid base spans and loose candidates of every text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base, loose = _spans(text)
    return docs.select(F.col("doc_id").alias("doc_id"), base.alias("base"), loose.alias("loose"))


def find_pii(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """One row per document: doc_id, base and method spans as arrays of (kind, start, end)."""
    found = materialise(candidates(docs), "candidates")
    model, limits = fit(docs.sparkSession, precision)
    plain = F.transform("base", lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("doc_id", plain.alias("base"), F.when(F.size("loose") > 0, _selected(model, limits)).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("method"))


def redact(text: Column, spans: Column) -> Column:
    """Text with each span replaced by its kind in brackets; overlapping spans count once."""
    ranked = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    return F.aggregate(
        ranked,
        F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")),
        lambda a, c: F.when(
            c["start"] >= a["pos"],
            F.struct(c["end"].alias("pos"), F.concat(a["out"], F.substring(text, a["pos"] + 1, c["start"] - a["pos"]), F.lit("["), F.upper(c["kind"]), F.lit("]")).alias("out")),
        ).otherwise(a),
        lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text))),
    )


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans."""
    found = find_pii(docs)
    of = lambda k: lambda c: c["kind"] == k
    count = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *count, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.concat("base", "method")).alias("spans"), F.size("method").cast("long").alias("n_method"))
