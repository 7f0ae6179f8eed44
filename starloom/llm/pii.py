"""Personal data: rule spans, plus candidates that boosted trees select.

Everything on the data path is DataFrame expressions over one row; there is no
Python on the executors and no shuffle of texts.

* *Base* spans: four patterns (e-mail, ip, card, phone), leftmost and
  non-overlapping per kind, each match checked (octets, Luhn, digit counts).
* *Candidates*: wider patterns of the same four kinds propose spans, which may
  overlap. Features describe the format (digits, separators, groups, checks)
  and the context (characters around, words before) in fixed small bins.
* *Boosted trees* (logistic loss, depth two) are fitted to the counts of
  feature combinations, labelled by agreement with a base span. The leading
  plus sign is no feature, so formats that miss only that can be recognised.
  A candidate that the base rules cannot judge (a phone number without the
  plus, an e-mail address with a domain but other characters) is no example of
  anything else: it counts as one only if its format or context fails
  (``_verdict``, ``_open``), and is left out of fit and calibration otherwise.
  Signed phone numbers are examples with and without their country code.
  Counting is one grouped aggregate over all documents; the number of
  combinations is bounded by the bins, and only that table reaches the driver.
* *Calibration*: on the half of the documents (by hash of the text) that the
  trees did not see, each kind's threshold is the lowest score at which the
  judged candidates above it agree with base spans at ``PRECISION`` or more;
  without ``MIN_AGREE`` agreeing candidates a kind selects nothing.

A candidate over its threshold that overlaps no base span is added; base spans
always stay. Offsets count code points from 0, ends exclusive.

The regular expressions only repeat single character classes (Java's engine
recurses on repeated groups), so very long runs are safe: separators inside a
number and dots inside a domain are first marked by a same-length replacement.

Defined cases: a null text is empty and has no spans; ``redacted`` leaves null
texts null. Rows that repeat get equal results. Columns other than doc_id and
text are ignored by ``scan``; ``redacted`` keeps all columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 30
RATE = 0.3
PRECISION = 0.99
MIN_AGREE = 20
CONTEXT = 24

# Words that announce a kind of number.
CONTEXT_WORDS = {
    1: "phone|tel|call|mobile|cell|fax|whatsapp|contact",
    2: "mail|write to|reply",
    3: "host|server|ip|addr|address|ping",
    4: "card|visa|master|amex|credit|debit|iban|account",
    5: "token|key|id|isbn|issn|version|order|invoice|date|page|no",
}
FEATURES = ("kind", "digits", "luhn", "separators", "groups", "lead", "tail", "context", "domain", "octets")

_ONE, _TWO = "\u0001", "\u0002"
_LOCAL, _DOMAIN = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_EMAIL = rf"(?:\G|(?<![{_TWO}{_LOCAL}]))[{_TWO}{_LOCAL}]++@[{_DOMAIN}]++{_TWO}[{_TWO}{_DOMAIN}]++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9][0-9{_ONE}]+"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_WIDE = {
    "email": r"[^\s@,;:<>()\[\]]++@[^\s@,;:<>()\[\]]++",
    "ip": r"(?<![0-9.])[0-9]++\.[0-9.]*+(?<=[0-9])",
    "card": rf"[0-9][0-9{_ONE}]{{6,}}",
    "phone": r"[+(]?[0-9][0-9 ().-]{5,}[0-9]",
}


def _marked(text: Column, mark: str, inside: str, chars: str) -> Column:
    """``chars`` between two ``inside`` characters become ``mark``; a mark that stands in the text becomes a control character."""
    return F.regexp_replace(F.translate(text, mark, "\u0003"), f"(?<=[{inside}])[{chars}](?=[{inside}])", mark)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where lambdas in ``use`` mention it."""
    return F.transform(F.array(value), use)[0]


def _chunked(items: Column, each) -> Column:
    """``each(first, chunk)`` for consecutive chunks of about sqrt(n) items; ``first`` counts from 0. No item, no chunk."""
    def run(p: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(p))).cast("int"), F.lit(1))
        starts = F.when(F.size(p) > 0, F.sequence(F.lit(0), F.greatest(F.size(p) - 1, F.lit(0)), width)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: each(i, F.slice(p, i + 1, width), p))

    return _bound(items, run)


_SPANS = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def _found(text: Column, pattern: str, ok=None) -> Column:
    """``array<struct<start, end, text, before, after>>`` of the matches that pass ``ok``: ``CONTEXT`` characters before, one after.

    Places are added up in chunks, then over chunks, and neighbours are carried
    along, so the cost is n * sqrt(n) small steps for n matches, and each
    character of the text is touched a fixed number of times.
    """
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(gaps, matches, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m")))
    first = lambda x: F.substring(F.concat(F.substring(x["gap"], 1, 1), F.substring(F.coalesce(x["m"], F.lit("")), 1, 1)), 1, 1)
    parts = _bound(parts, lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), lambda x, after: F.struct(
        x["gap"].alias("gap"), x["m"].alias("m"), F.coalesce(first(after), F.lit("")).alias("after"))))
    tail = lambda x: F.right(x, F.lit(CONTEXT))

    def step(acc: Column, x: Column) -> Column:
        m = F.coalesce(x["m"], F.lit(""))
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(m)
        before = tail(F.concat(acc["tail"], tail(x["gap"])))
        valid = x["m"].isNotNull() if ok is None else x["m"].isNotNull() & ok(x["m"])
        more = F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("text"), before.alias("before"),
                                                     x["after"].alias("after"))))
        return F.struct(end.alias("at"), tail(F.concat(before, m)).alias("tail"), F.when(valid, more).otherwise(acc["out"]).alias("out"))

    def chunk(i: Column, own: Column, every: Column) -> Column:
        # a match has a character at least, so that many earlier ones reach back far enough
        earlier = F.slice(every, F.greatest(i - CONTEXT, F.lit(0)) + 1, F.least(i, F.lit(CONTEXT)))
        known = tail(F.array_join(F.transform(earlier, lambda x: F.concat(tail(x["gap"]), F.coalesce(x["m"], F.lit("")))), ""))
        return F.aggregate(own, F.struct(F.lit(0).alias("at"), known.alias("tail"), F.array().cast(_SPANS).alias("out")), step,
                           lambda acc: F.struct(acc["at"].alias("at"), acc["out"].alias("out")))

    def moved(acc: Column, c: Column) -> Column:
        out = F.transform(c["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"),
                                                       s["text"].alias("text"), s["before"].alias("before"), s["after"].alias("after")))
        return F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["out"], F.array(out)).alias("out"))

    return F.aggregate(_chunked(parts, chunk), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out")), moved,
                       lambda acc: F.flatten(acc["out"]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    doubled = lambda v: v * 2 - F.when(v > 4, 9).otherwise(0)
    total = F.aggregate(at, F.lit(0), lambda acc, i: acc + F.when(i % 2 == 0, doubled(value(i))).otherwise(value(i)))
    return F.coalesce(total % 10 == 0, F.lit(False))


def _octets_ok(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3)
                    & (F.coalesce(F.substring(F.ltrim(x, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))


def _views(text: Column) -> dict[str, Column]:
    return {"email": _marked(text, _TWO, _DOMAIN, "."), "ip": text, "card": _marked(text, _ONE, "0-9", " -"), "phone": text}


def _may_hold(text: Column) -> dict[str, Column]:
    number = text.rlike("[0-9]")
    return {"email": text.contains("@"), "ip": number & text.contains("."), "card": number, "phone": text.contains("+")}


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind by the fixed rules."""
    views, may = _views(text), _may_hold(text)
    none = F.array().cast(_SPANS)
    count = lambda m: F.length(_digits(m))
    rules = {
        "email": (_EMAIL, None),
        "ip": (_IP, _octets_ok),
        "card": (_CARD, lambda m: count(m).between(13, 19) & F.when(count(m).between(13, 19), luhn(_digits(m))).otherwise(False)),
        "phone": (_PHONE, lambda m: count(m).between(9, 15)),
    }
    return {k: F.when(may[k], _found(views[k], *rules[k])).otherwise(none) for k in KINDS}


def _bin(value: Column, edges: list[int]) -> Column:
    """Number of ``edges`` that ``value`` reaches."""
    out = F.lit(0)
    for i, edge in enumerate(edges):
        out = F.when(value >= edge, i + 1).otherwise(out)
    return out


def _beside(c: Column) -> Column:
    return F.when((c == "") | c.rlike(r"^\s$"), 0).when(c.rlike("[A-Za-z]"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def _shape(m: Column) -> list[Column]:
    """Format features of one match."""
    digits, n = _digits(m), F.length(_digits(m))
    return [
        _bin(n, [1, 7, 9, 10, 11, 12, 13, 16, 17, 20]).alias("digits"),
        F.when(n.between(13, 19), F.when(luhn(digits), 1).otherwise(0)).otherwise(0).alias("luhn"),
        sum((F.when(m.contains(ch), 1 << i).otherwise(0) for i, ch in enumerate("(-. ")), F.lit(0)).alias("separators"),
        F.least(F.lit(6), F.size(F.filter(F.split(m, "[^0-9]+"), lambda x: x != ""))).alias("groups")]


def candidates(text: Column, phones: bool = False) -> Column:
    """``array<struct<start, end, kind, digits, ...>>``: wide spans of all kinds with their features, and the ``phone`` itself if asked for."""
    views, number = _views(text), text.rlike("[0-9]")
    may = {"email": text.contains("@"), "ip": number, "card": number, "phone": number}
    none = F.array().cast(_SPANS)

    def described(kind: str):
        def one(c: Column) -> Column:
            m = c["text"]
            plain = F.translate(m, _ONE + _TWO, " .")
            before = F.lower(c["before"])
            context = F.lit(0)
            for code, found in sorted(CONTEXT_WORDS.items(), reverse=True):
                context = F.when(before.rlike(rf"(?:^|[^a-z])(?:{found})[^a-z]*$"), code).otherwise(context)
            parts = F.size(F.split(m, r"\."))
            return F.struct(
                c["start"].alias("start"), c["end"].alias("end"), F.lit(KINDS.index(kind)).alias("kind"),
                (m.startswith("+") if kind == "phone" else F.lit(True)).alias("signed"),
                *_shape(plain),
                _beside(F.right(c["before"], F.lit(1))).alias("lead"), _beside(c["after"]).alias("tail"), context.alias("context"),
                (F.when(plain.rlike(r"@[A-Za-z0-9.-]*\.[A-Za-z]{2,24}$"), 1).otherwise(0) if kind == "email" else F.lit(0)).alias("domain"),
                (F.when(_octets_ok(m) & (parts == 4), 2).when(parts == 4, 1).otherwise(0) if kind == "ip" else F.lit(0)).alias("octets"),
                *([(m if kind == "phone" else F.lit("")).alias("phone")] if phones else []))

        return one

    return F.concat(*[F.transform(F.when(may[k], _found(views[k], _WIDE[k])).otherwise(none), described(k)) for k in KINDS])


def _ranges(spans: Column) -> Column:
    """Spans of one kind, which ascend and lie apart, in chunks with the range of each."""
    return _chunked(spans, lambda i, own, every: F.struct(own[0]["start"].alias("start"), F.element_at(own, -1)["end"].alias("end"), own.alias("spans")))


def _overlaps(c: Column, ranges: Column) -> Column:
    """Whether ``c`` overlaps a span of ``_ranges``; only chunks that it meets are opened."""
    meets = lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
    return F.exists(ranges, lambda r: meets(r) & F.exists(r["spans"], meets))


# ------------------------------------------------------------------ boosting

@dataclass
class Tree:
    """Tests ``feature <= value`` of depth two; leaves hold log-odds."""

    tests: list[tuple[int, int]]
    leaves: list[float]

    def values(self, x: np.ndarray) -> np.ndarray:
        a, b, c = (x[:, f] <= v for f, v in self.tests)
        return np.where(a, np.where(b, *self.leaves[:2]), np.where(c, *self.leaves[2:]))

    def column(self, c: Column) -> Column:
        a, b, d = (c[FEATURES[f]] <= v for f, v in self.tests)
        w = self.leaves
        return F.when(a, F.when(b, w[0]).otherwise(w[1])).otherwise(F.when(d, w[2]).otherwise(w[3]))


@dataclass
class Model:
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=lambda: [float("inf")] * len(KINDS))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return sum((t.values(x) for t in self.trees), np.full(len(x), self.start))  # added up as in ``column``: thresholds are met exactly

    def column(self, c: Column) -> Column:
        return sum((t.column(c) for t in self.trees), F.lit(self.start))

    def selects(self, c: Column) -> Column:
        """Whether a candidate's score reaches the threshold of its kind."""
        out = F.lit(False)
        for k, t in enumerate(self.thresholds):
            if np.isfinite(t):
                out = out | ((c["kind"] == k) & (self.column(c) >= t))
        return out


def _split(x: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple[int, int]:
    """The test with the largest gain over weighted rows."""
    best, pick = -1.0, (0, 10**6)
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= v
            g, h = grad[left].sum(), hess[left].sum()
            gain = g * g / (h + 1) + (grad.sum() - g) ** 2 / (hess.sum() - h + 1)
            if gain > best + 1e-12:
                best, pick = gain, (f, int(v))
    return pick


def boost(x: np.ndarray, n: np.ndarray, agree: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Boosted trees on cells: feature rows, their count and how many agree with a base span."""
    share = (agree.sum() + 0.5) / (n.sum() + 1)
    model = Model(start=float(np.log(share / (1 - share))))
    raw = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = agree - n * p, n * p * (1 - p)
        root = _split(x, grad, hess)
        side = x[:, root[0]] <= root[1]
        tests = [root, *(_split(x[s], grad[s], hess[s]) if s.any() else (0, 0) for s in (side, ~side))]
        leaf = np.where(side, np.where(x[:, tests[1][0]] <= tests[1][1], 0, 1), np.where(x[:, tests[2][0]] <= tests[2][1], 2, 3))
        leaves = [float(rate * grad[leaf == i].sum() / (hess[leaf == i].sum() + 1)) for i in range(4)]
        model.trees.append(Tree(tests, leaves))
        raw = raw + model.trees[-1].values(x)
    return model


def threshold(score: np.ndarray, n: np.ndarray, agree: np.ndarray, precision: float = PRECISION, least: int = MIN_AGREE) -> float:
    """The lowest score above which the agreeing share is at least ``precision``."""
    order = np.argsort(-score, kind="stable")
    s, total, good = score[order], np.cumsum(n[order]), np.cumsum(agree[order])
    last = np.append(s[1:] != s[:-1], True)  # equal scores stand or fall together
    ok = last & (good >= precision * total) & (good >= least)
    return float(s[np.flatnonzero(ok)[-1]]) if ok.any() else float("inf")


def _verdict(c: Column, base: Column) -> Column:
    """1: agrees with a base span; 0: is none; null: the base rules cannot judge it, its format and context pass."""
    kind = lambda k: c["kind"] == KINDS.index(k)
    phone = kind("phone") & ~c["signed"] & c["digits"].between(3, 7) & c["context"].isin(0, 1)  # 9 to 15 digits
    email = kind("email") & (c["domain"] == 1)
    beside = c["lead"].isin(1, 2) | c["tail"].isin(1, 2)
    other = F.exists(base, lambda spans: _overlaps(c, spans))
    return F.when(_overlaps(c, F.element_at(base, c["kind"] + 1)), 1).when((phone | email) & ~beside & ~other, None).otherwise(0)


def _layout(r) -> tuple[int, ...]:
    return r.kind, r.digits, r.separators, r.groups


def _open(r, agreed: dict[tuple[int, ...], int]) -> bool:
    """Whether an unjudged cell stays so: its context announces the kind, or signed numbers are often laid out like it."""
    return KINDS[r.kind] != "phone" or r.context == 1 or (r.separators > 0 and agreed.get(_layout(r), 0) >= MIN_AGREE)


def train(docs: DataFrame) -> Model:
    """Fit trees on one half of the documents and thresholds on the other."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(text.alias("text")).filter(F.col("text").rlike("[0-9@]"))
    base = F.array(*[_ranges(F.transform(s, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))) for s in base_spans(F.col("text")).values()])
    found = rows.select((F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("fit"), base.alias("base"), candidates(F.col("text"), phones=True).alias("found"))
    one = found.select("fit", "base", F.explode("found").alias("c")).select("fit", "c.*", _verdict(F.col("c"), F.col("base")).alias("agree"))
    # a signed number without its country code is an example too, of how numbers are written in their country
    short = F.regexp_replace("phone", r"^\+[0-9]{1,3}(?:[ .-]+|(?=\())", "")
    shape = lambda *columns: F.array(F.struct(*columns))
    shapes = shape("digits", "luhn", "separators", "groups")
    twice = F.filter(F.concat(shapes, shape(*_shape(short))), lambda x: x["digits"].between(3, 7))
    one = one.withColumn("shape", F.explode(F.when((F.col("agree") == 1) & (short != F.col("phone")), twice).otherwise(shapes))).select(
        "fit", "agree", *[F.col(f"shape.{f}") if f in ("digits", "luhn", "separators", "groups") else F.col(f) for f in FEATURES])
    cells = one.groupBy("fit", *FEATURES).agg(F.count(F.lit(1)).alias("n"), F.count("agree").alias("judged"), F.sum("agree").alias("agree")).collect()
    cells.sort(key=lambda r: tuple(r[c] for c in ("fit", *FEATURES)))
    agreed: dict[tuple[int, ...], int] = {}
    for r in cells:
        agreed[_layout(r)] = agreed.get(_layout(r), 0) + (r.agree or 0)

    def arrays(fit: bool):
        own = [(r, r.judged if _open(r, agreed) else r.n) for r in cells if r.fit is fit]
        own = [(r, n) for r, n in own if n]
        return (np.array([[r[f] for f in FEATURES] for r, _ in own], np.int64).reshape(-1, len(FEATURES)),
                np.array([n for _, n in own], float), np.array([r.agree or 0 for r, _ in own], float))

    x, n, agree = arrays(True)
    if not len(x) or agree.sum() == 0:
        return Model()
    model = boost(x, n, agree)
    x, n, agree = arrays(False)
    score = model.raw(x)
    model.thresholds = [threshold(score[x[:, 0] == k], n[x[:, 0] == k], agree[x[:, 0] == k]) for k in range(len(KINDS))]
    return model


# ----------------------------------------------------------------- applying

def _added(taken: Column, found: Column, model: Model, kind: str) -> Column:
    k = KINDS.index(kind)
    picked = F.filter(found, lambda c: (c["kind"] == k) & model.selects(c) & ~_overlaps(c, taken))
    return F.transform(picked, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end")))


def with_spans(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` as struct ``row`` with ``base_<kind>`` and ``all_<kind>``: arrays of (start, end), by start."""
    plain = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")
    short = lambda s: F.transform(s, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    rows = plain.select("row", "text", *[short(s).alias(f"base_{k}") for k, s in base_spans(text).items()])
    base = {k: F.col(f"base_{k}") for k in KINDS}
    if any(np.isfinite(t) for t in model.thresholds):
        rows = rows.select("*", F.when(text.rlike("[0-9@]"), candidates(text)).alias("found"), F.concat(*[_ranges(b) for b in base.values()]).alias("taken"))
        found = F.coalesce(F.col("found"), F.array().cast(rows.schema["found"].dataType))
        every = {k: F.array_sort(F.concat(base[k], _added(F.col("taken"), found, model, k))) for k in KINDS}
    else:
        every = base
    return rows.select("row", "text", *base.values(), *[every[k].alias(f"all_{k}") for k in KINDS])


def _listed(prefix: str) -> Column:
    def one(kind: str) -> Column:
        return F.transform(F.col(f"{prefix}_{kind}"), lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.concat(*[one(k) for k in KINDS])


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` for every row."""
    rows = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model or train(docs))
    return rows.select(
        "row.doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", _listed("base")), 256).alias("base_sha256"), F.concat_ws(",", _listed("all")).alias("spans"),
        (F.size(_listed("all")) - F.size(_listed("base"))).cast("long").alias("n_added"))


def redacted(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one. ``n_chars`` follows if present."""
    rows = with_spans(docs, model or train(docs))

    def labelled(kind: str) -> Column:
        return F.transform(F.col(f"all_{kind}"), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("label")))

    spans = F.array_sort(F.concat(*[labelled(k) for k in KINDS]))

    # chunks of spans, each with the piece of text from the end of all earlier ones to its own
    def reach(i: Column, own: Column, every: Column) -> Column:
        return F.struct(own.alias("spans"), F.array_max(F.transform(own, lambda x: x["end"])).alias("end"))

    def placed(acc: Column, c: Column) -> Column:
        end = F.greatest(acc["at"], c["end"])
        piece = F.substring(F.col("text"), acc["at"] + 1, end - acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            acc["at"].alias("at"), piece.alias("piece"), c["spans"].alias("spans")))).alias("out"))

    def replaced(c: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            gap = F.substring(c["piece"], acc["at"] - c["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
            more = F.concat(acc["out"], F.array(gap, x["label"]))
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] < acc["at"], acc["out"]).otherwise(more).alias("out"))

        start = F.struct(c["at"].alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(c["spans"], start, step, lambda acc: F.array_join(acc["out"], ""))

    pieces = "array<struct<at:int,piece:string,spans:array<struct<start:int,end:int,label:string>>>>"
    clean = F.aggregate(_chunked(F.col("spans"), reach), F.struct(F.lit(0).alias("at"), F.array().cast(pieces).alias("out")), placed,
                        lambda acc: F.concat(F.array_join(F.transform(acc["out"], replaced), ""),
                                             F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    rows = rows.select("row", "text", spans.alias("spans"))
    rows = rows.select("row", F.when(F.size("spans") > 0, clean).otherwise(F.col("row.text")).alias("clean"))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("clean").isNull(), F.col("row.n_chars")).otherwise(F.length("clean")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
