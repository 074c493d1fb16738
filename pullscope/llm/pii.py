"""Personal data by candidate gradient boosting, with built-in SQL functions only.

Base rules find email addresses, IP addresses, card numbers and phone numbers; their spans always stay.
Loose generators propose further, overlapping spans (spelled-out addresses, national phone numbers, IPv6, shorter
or dotted cards). Every candidate is described by yes/no features of its format and its context.

Boosted trees learn from weak labels what personal data looks like in the loose forms. Each valid base span is
rewritten into such a form where it stands (its echo: an address with "(at)" and "(dot)", a phone number without its country code, a
card number of 15 digits, an IPv6 address), once in its own context and once as behind a cue word: echoes are the examples of
personal data. Failed base matches, plain numbers, and loose candidates with evidence against them (cut out of a longer word,
one digit throughout, an unusual length, a card without a valid check digit) are the examples of the contrary, if they overlap no
base span and no other loose candidate; these teach nothing, as they may be what is looked for. Half of the examples fit the trees, the other half sets each kind's threshold, where the share
of echoes at and above it is ``PRECISION`` or more.

One scan of the texts finds all candidates of all generators; a text's start positions come from running sums
over the pieces between matches (a window per document over its few matches). Training data is a
contingency table of features (one row per combination, so its size has a bound that does not depend on the data), and
the trees are scored as CASE expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pullscope.llm.text import new_folder, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
ROUNDS = 24
RATE = 0.3

_LOCAL = r"[A-Za-z0-9._%+-]"
#: Base rules. The guards in front only save retries inside a run of characters that cannot match.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:(?![ -][^0-9])(?![ -]\z)[0-9 -])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Loose generators, and plain numbers as examples of what is not personal.
LOOSE = {
    "email": _LOCAL + r"{1,64}(?: ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,64}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| ?\{dot\} ?| dot )[A-Za-z0-9-]{1,64}){1,5}"
    r"| at [A-Za-z0-9-]{1,64}(?: dot [A-Za-z0-9-]{1,64}){1,5})",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}",
    "card": r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}",
    "phone": r"(?<![0-9])\(?[0-9]{2,5}\)?[ .-]?(?:[0-9]{2,5}[ .-]){1,3}[0-9]{2,5}",
}
NUMBER = r"[0-9]++(?:[.,:/-][0-9]++)*+"
#: Words that introduce personal data (fixed values).
CUES = {
    "email": "e-?mail|mail|contact|write|reach|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|login|client",
    "card": "card|visa|mastercard|amex|credit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|fax|mobile|cell|telefon|llame|appel",
}
FEATURES = ("clean_left", "clean_right", "cue", "grouped", "usual_length", "checksum", "tail_groups", "one_digit", "bracketed", "known_end")
#: Last labels of host names (fixed values).
ENDS = "com|org|net|edu|gov|info|io|de|fr|es|uk|eu"


def _matches(name: str, pattern: str, needs: Column) -> Column:
    return F.when(needs, F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))).alias(f"m_{name}")


def _pieces(name: str, pattern: str) -> Column:
    """The pieces of the text between matches, where there are matches."""
    return F.when(F.size(f"m_{name}") > 0, F.split(F.col("text"), pattern, -1)).alias(f"g_{name}")


def _listed(name: str) -> Column:
    """Matches of one generator: place in order, length of the piece before, match, contexts."""
    m, gaps = F.col(f"m_{name}"), F.col(f"g_{name}")
    zipped = F.arrays_zip(m.alias("m"), gaps.alias("g"), F.slice(gaps, F.lit(2), F.size(m)).alias("h"))
    each = F.transform(F.filter(zipped, lambda z: z["m"].isNotNull()), lambda z, i: F.struct(
        F.lit(name).alias("gen"), i.cast("long").alias("i"), F.length(z["g"]).cast("long").alias("gap"),
        z["m"].alias("match"), F.right(z["g"], F.lit(24)).alias("left"),
        F.left(F.coalesce(z["h"], F.lit("")), F.lit(8)).alias("right")))
    return F.when(F.size(m) > 0, each)


def _luhn_sum(digits: Column) -> Column:
    """Sum of a string of digits with every second one from the right doubled."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
                         lambda c, i: F.when(i % 2 == 1, F.element_at(doubled, c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _luhn(digits: Column) -> Column:
    """True where a string of digits has a valid check digit."""
    return _luhn_sum(digits) % 10 == 0


def _echo(kind: Column, match: Column, digits: Column) -> Column:
    """A base span in a form of the loose generators; which one depends on a hash of the span."""
    pick = F.pmod(F.xxhash64(match), F.lit(4))

    def one_of(*options: str) -> Column:
        out = F.lit(options[0])
        for k, option in enumerate(options[1:], 1):
            out = F.when(pick == k, F.lit(option)).otherwise(out)
        return out

    host = F.replace(F.substring_index(match, "@", -1), F.lit("."), one_of(" (dot) ", " [dot] ", ".", " dot "))
    email = F.concat(F.substring_index(match, "@", 1), one_of(" (at) ", " [at] ", "(at)", " at "), host)
    parts = F.transform(F.split(match, r"\."), lambda p: F.lower(F.hex(F.coalesce(p.try_cast("long"), F.lit(0)))))
    ip = F.concat(F.lit("2001:db8:0:1:"), F.array_join(parts, ":"))
    fourteen = F.left(digits, F.lit(14))
    check = F.pmod(10 - _luhn_sum(F.concat(fourteen, F.lit("0"))), F.lit(10)).cast("string")
    gap = one_of("", " ", "-", "")
    card = F.concat(F.left(fourteen, F.lit(4)), gap, F.substring(fourteen, 5, 6), gap, F.substring(fourteen, 11, 4), check)
    phone = F.regexp_replace(match, r"^\+[0-9]{1,3}[ .-]?", "")
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).otherwise(phone)


def _valid(kind: Column, match: Column, digits: Column) -> Column:
    n = F.length(digits)
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return (F.when(kind == "ip", match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(8, 15)).otherwise(True))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate (and one without a candidate for texts that have none), and one per valid base span's
    echo: rid, doc_id, gen, kind, base (from a base rule), valid (passes its checks), start, end (code points) and ``FEATURES``
    (an echo has the place and the context of its span)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    at, digit = F.instr(F.col("text"), "@") > 0, F.col("text").rlike("[0-9]")
    needs = {"email": at, "ip": F.col("text").rlike(r"[0-9]\.[0-9]"), "card": digit, "phone": F.instr(F.col("text"), "+") > 0,
             "loose_email": F.col("text").rlike(r"[(\[{ ]at[)\]} ]"), "loose_ip": F.col("text").rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
             "loose_card": F.col("text").rlike(r"[0-9][ .-]?[0-9]"), "loose_phone": F.col("text").rlike(r"[0-9][ .)-]"),
             "number": digit}
    patterns = {**BASE, **{f"loose_{k}": p for k, p in LOOSE.items()}, "number": NUMBER}
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = rows.select("rid", "doc_id", "text", *[_matches(g, p, needs[g]) for g, p in patterns.items()])
    found = found.select("rid", "doc_id", *[f"m_{g}" for g in patterns], *[_pieces(g, p) for g, p in patterns.items()])
    none = F.array().cast("array<struct<gen:string,i:bigint,gap:bigint,match:string,left:string,right:string>>")
    listed = found.select("rid", "doc_id", F.explode_outer(
        F.concat(*[F.coalesce(_listed(g), none) for g in patterns])).alias("h")).select("rid", "doc_id", "h.*")
    # a match and, if it is a valid base span, its echo
    bare = F.regexp_replace("gen", "^loose_", "")
    plain = F.regexp_replace("match", "[^0-9]", "")
    is_base = F.col("gen").isin(*KINDS)
    good = F.coalesce(_valid(bare, F.col("match"), plain), F.lit(False))
    own_form = F.struct(F.col("gen").alias("gen"), F.col("match").alias("match"))
    echo = _echo(F.col("gen"), F.col("match"), plain)
    echoes = [F.struct(F.concat(F.lit(f"{name}_"), F.col("gen")).alias("gen"), echo.alias("match")) for name in ("echo", "echo_cue")]
    listed = listed.select("rid", "doc_id", "i", "gap", F.length("match").cast("long").alias("size"), "left", "right", good.alias("valid"),
                           F.explode(F.when(is_base & good, F.array(own_form, *echoes)).otherwise(F.array(own_form))).alias("v"))
    listed = listed.select("rid", "doc_id", "i", "gap", "size", "left", "right", "valid", "v.gen", "v.match")
    kind = F.regexp_replace("gen", "^(?:loose|echo_cue|echo)_", "")
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    own = F.when(kind == "number", F.lit("phone")).otherwise(kind)
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = F.when(own == k, F.col("left").rlike(rf"(?i)(?:^|[^a-z])(?:{words})[^a-z]{{0,6}}$")).otherwise(cue)
    described = {
        "clean_left": ~F.col("left").rlike(r"[\p{L}0-9._%/=\"-]$"),
        "clean_right": ~F.col("right").rlike(r"^[\p{L}0-9_%/=\"]"),
        "cue": cue | F.startswith(F.col("gen"), F.lit("echo_cue_")),
        "grouped": F.col("match").rlike(r"[0-9A-Za-z][ ()\[\]{}.:-]+[0-9A-Za-z]"),
        "usual_length": F.when(own == "phone", n.between(9, 13)).when(own == "card", n.between(13, 19))
        .when(own == "ip", n.between(4, 32)).otherwise(F.length("match").between(6, 80)),
        "checksum": F.when((own == "card") & n.between(13, 19), _luhn(digits)).otherwise(F.lit(False)),
        "tail_groups": (own == "phone") & F.col("match").rlike(r"[0-9]{3}[ .-][0-9]{4}$|[0-9]{4}[ .-][0-9]{4}$"),
        "one_digit": (own != "email") & digits.rlike(r"^([0-9])\1*$"),
        "bracketed": F.col("match").rlike(r"[(\[{]at[)\]}]"),
        "known_end": F.col("match").rlike(rf"(?i)[^a-z](?:{ENDS})$"),
    }
    table = listed.select(
        "rid", "doc_id", "gen", F.when(kind == "number", F.lit(None)).otherwise(kind).alias("kind"), "i", "gap", "size",
        is_base.alias("base"), "valid",
        *[F.coalesce(c, F.lit(False)).alias(name) for name, c in described.items()])
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("rid", "gen").orderBy("i"))
    return (table.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size")).drop("i", "gap", "size"))


@dataclass
class Trees:
    """Boosted trees of depth two over yes/no inputs: (first test, values if false / true: (test, low, high))."""

    base: float
    trees: list[tuple[str, tuple[str, float, float], tuple[str, float, float]]]
    cuts: dict[str, float]

    def score(self) -> Column:
        total = F.lit(self.base)
        for first, no, yes in self.trees:
            def leaf(side):
                test, low, high = side
                return F.when(F.col(test), F.lit(high)).otherwise(F.lit(low))
            total = total + F.when(F.col(first), leaf(yes)).otherwise(leaf(no))
        return total

    def value(self, row: dict) -> float:
        total = self.base
        for first, no, yes in self.trees:
            test, low, high = yes if row[first] else no
            total += high if row[test] else low
        return total


def _gain(rows: list[dict]) -> tuple[float, float]:
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    return g * g / (h + 1.0), g / (h + 1.0)


def boost(table: list[dict], rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION) -> Trees | None:
    """Newton boosting on a contingency table: rows of inputs, ``pos`` and ``neg`` counts and ``kind``; thresholds from the
    counts ``cal_pos`` and ``cal_neg`` where they are given. None where a class is missing."""
    pos, neg = sum(r["pos"] for r in table), sum(r["neg"] for r in table)
    if not pos or not neg:
        return None
    inputs = [*FEATURES, *[f"is_{k}" for k in KINDS]]
    rows = [dict(r, f=math.log(pos / neg)) for r in sorted(table, key=lambda r: tuple(r[x] for x in inputs))]
    trees = []
    for _ in range(rounds):
        for r in rows:
            p = 1 / (1 + math.exp(-r["f"]))
            r["g"], r["h"] = r["pos"] - (r["pos"] + r["neg"]) * p, (r["pos"] + r["neg"]) * p * (1 - p)

        def best(part: list[dict]) -> tuple[float, tuple[str, float, float]]:
            options = []
            for x in inputs:
                (a, low), (b, high) = _gain([r for r in part if not r[x]]), _gain([r for r in part if r[x]])
                options.append((a + b, (x, rate * low, rate * high)))
            return max(options, key=lambda o: o[0])

        tries = []
        for x in inputs:
            (a, no), (b, yes) = best([r for r in rows if not r[x]]), best([r for r in rows if r[x]])
            tries.append((a + b, (x, no, yes)))
        tree = max(tries, key=lambda o: o[0])[1]
        trees.append(tree)
        one = Trees(0.0, [tree], {})
        for r in rows:
            r["f"] += one.value(r)
    cuts = {}
    for kind in KINDS:
        own = sorted((r for r in rows if r[f"is_{kind}"]), key=lambda r: -r["f"])
        good = bad = 0
        for k, r in enumerate(own):
            here = r.get("cal_pos", r["pos"])
            good, bad = good + here, bad + r.get("cal_neg", r["neg"])
            tied = k + 1 < len(own) and own[k + 1]["f"] >= r["f"] - 1e-9
            if not tied and good and good >= precision * (good + bad):
                cuts[kind] = r["f"] - 1e-6
    return Trees(math.log(pos / neg), trees, cuts)


def _in_order(*by: str | tuple[str, bool]) -> tuple[WindowSpec, WindowSpec]:
    """Windows over the rows of a document before a row and after it, in the order of some columns, (column, True) for a
    falling one. Both are running frames; a frame that looks ahead would be computed anew for each row."""
    columns = [(c, False) if isinstance(c, str) else c for c in by]
    each = Window.partitionBy("rid")
    return tuple(each.orderBy(*[F.desc_nulls_last(c) if falls != turned else F.asc_nulls_first(c) for c, falls in columns])
                 .rowsBetween(Window.unboundedPreceding, -1) for turned in (False, True))


def train(table: DataFrame, precision: float = PRECISION) -> Trees | None:
    """Fit on stored ``candidates``. Echoes of base spans are examples of personal data; failed base matches, numbers (for
    every kind of digits) and loose candidates with evidence against them, if they overlap no base span, are
    examples of the contrary."""
    against = (~F.col("clean_left") | ~F.col("clean_right") | F.col("one_digit") | ~F.col("usual_length")
               | ((F.col("kind") == "card") & ~F.col("checksum")))
    span = F.col("base") & F.col("valid")
    open_ = F.startswith(F.col("gen"), F.lit("loose_")) & ~against
    order, back = _in_order("start", ("end", True), "gen")
    before = F.max(F.when(span | open_, F.col("end"))).over(order)
    after = F.min(F.when(span | open_, F.col("start"))).over(back)
    own = table.where("gen is not null and not startswith(gen, 'echo_')").withColumn("before", before).withColumn("after", after)
    free = (F.coalesce("before", F.lit(-1)) <= F.col("start")) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))
    kinds = F.when(F.col("gen") == "number", F.array(F.lit("ip"), F.lit("card"), F.lit("phone"))).otherwise(F.array("kind"))
    others = own.where(~span & ~open_ & free).withColumn("kind", F.explode(kinds))
    fold = F.pmod(F.xxhash64("doc_id", "start", "kind"), F.lit(2)).alias("fold")
    cols = ["kind", *FEATURES]
    labelled = (table.where("startswith(gen, 'echo_')").select(*cols, fold, F.lit(1).cast("long").alias("y"))
                .union(others.select(*cols, fold, F.lit(0).cast("long").alias("y"))))
    counted = labelled.groupBy(*cols).agg(*[F.count(F.when((F.col("fold") == f) & (F.col("y") == y), 1)).alias(name)
                                            for name, f, y in (("pos", 0, 1), ("neg", 0, 0), ("cal_pos", 1, 1), ("cal_neg", 1, 0))])
    got = [r.asDict() for r in counted.collect()]  # at most one row per combination of kind and features
    for r in got:
        r |= {f"is_{k}": r["kind"] == k for k in KINDS}
    return boost(got, precision=precision)


def personal_data(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per input row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 and spans (base and
    added spans), both over ``kind:start:end`` by kind, then start, comma-joined; and n_added.

    Starts are code points, ends exclusive. An added span never overlaps a base span or an earlier
    added one. Null texts are empty; repeated rows and null ids are rows like others; other columns are ignored.
    """
    folder = new_folder(docs.sparkSession, "pii")
    table = stored(candidates(docs), f"{folder}/candidates")
    trees = train(table, precision)
    kept = table.where("gen is null or not startswith(gen, 'echo_')").withColumn("base", F.col("base") & F.col("valid"))
    chosen = F.lit(False)
    if trees is not None:
        flagged = kept.withColumns({f"is_{k}": F.coalesce(F.col("kind") == k, F.lit(False)) for k in KINDS})
        kept = flagged.withColumn("score", trees.score())
        for kind, cut in trees.cuts.items():
            chosen = chosen | ((F.col("kind") == kind) & (F.col("score") >= cut))
    loose = F.coalesce(F.col("gen").startswith("loose_"), F.lit(False))
    kept = kept.withColumn("extra", loose & F.coalesce(chosen, F.lit(False)) & F.col("clean_left") & F.col("clean_right"))
    spans = kept.where("gen is null or base or extra").select("rid", "doc_id", "kind", "start", "end", "base", "extra")
    # every document has a row, so that texts whose candidates are all dropped stay
    spans = spans.union(kept.where("gen is not null and not base and not extra").select(
        "rid", "doc_id", F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(False), F.lit(False))
        .distinct())
    earlier, later = _in_order("start", ("base", True), ("end", True), "kind")
    spans = (spans.withColumn("reached", F.max("end").over(earlier))
             .withColumn("next_base", F.min(F.when(F.col("base"), F.col("start"))).over(later)))
    free = (F.coalesce("reached", F.lit(-1)) <= F.col("start")) & F.coalesce(F.col("next_base") >= F.col("end"), F.lit(True))
    rank = F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col("kind"))
    spans = spans.withColumn("added", F.col("extra") & free).withColumn("rank", F.when(F.col("kind").isNotNull(), rank))
    one = F.struct("rank", "start", F.concat_ws(":", "kind", "start", "end").alias("s"))
    joined = lambda name: F.concat_ws(",", F.transform(F.sort_array(name), lambda x: x["s"]))
    out = spans.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"),
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.collect_list(F.when(F.col("base"), one)).alias("b"),
        F.collect_list(F.when(F.col("base") | F.col("added"), one)).alias("a"),
        F.count(F.when(F.col("added"), 1)).alias("n_added"))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined("b"), 256).alias("base_sha256"),
                      joined("a").alias("spans"), "n_added")
