"""Operator 11, personal data: weak-supervision aggregation.

Base spans (one pattern and one test per kind) always stand.  A looser pattern
per kind proposes more candidates in the rest of the text: numbers that a base
pattern ran together with a neighbour, local phone formats, written-out
addresses.  Six labelers (regular expressions, gazetteers, context) vote yes, no
or nothing on every candidate, base ones too; expectation-maximisation estimates,
without a single given label, how often each labeler votes what on personal data
and on other text; its posteriors train a logistic span classifier on the votes
and the span's form; candidates that it scores ``cut`` or more are added.

DataFrame functions only.  Candidates are found with their places where the
text is read; afterwards no text moves.  Training needs one count per distinct
pattern of votes and form (3^6 * 2^4 per kind at most, whatever the corpus), on
which both models are folded with array functions; they come back as a few
dozen numbers per kind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import col, packed, parked
from capstan.llm.registry import query
from capstan.tables import table

KINDS = ("email", "ip", "card", "phone")

# Possessive repeats (``++``) take what the contract's patterns take, as no part
# of them ever has to give characters back, but need neither stack nor retries
# on very long runs.  A look-behind starts a run of characters at its first one;
# ``\G`` lets a match begin where the last one ended inside a run.
LOCAL = r"A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Candidates in the rest of the text: what looks like the kind (first lines),
#: and any number or handle (last lines), from which the models learn a no.
MORE = {
    "email": (rf"(?i)(?<![{LOCAL}])[A-Z0-9._%+-]{{1,64}}+(?: ?[\[(]at[\])] ?[A-Z0-9-]++(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Z0-9-]++){{1,8}}+| at [A-Z0-9-]++(?: dot [A-Z0-9-]++){{1,8}}+)"
              rf"|(?<![{LOCAL}@])[{LOCAL}]*+@[A-Za-z0-9.-]*+"),
    "ip": (r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
           r"|(?<![0-9.])[0-9]++(?:\.[0-9]++)++"),
    "card": (r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])"
             r"|(?<![0-9])[0-9]{6,}+"),
    "phone": (r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-][0-9]{2,4}){2}(?![0-9])"
              r"|(?<![0-9+])00[1-9][0-9]{0,2}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])"
              r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
              r"|(?<![0-9])[0-9]{3,}+(?:[ .-][0-9]{2,}+){0,8}+"),
}
#: What a text must hold for a base match, and for a further candidate.
HINT = {"email": ("contains(text, '@')", r"rlike(text, r'(?i)@|[\[(]at[\])]| dot ')"), "ip": ("contains(text, '.')", r"rlike(text, r'[0-9]\.[0-9]|[0-9A-Fa-f]:')"),
        "card": ("rlike(text, '[0-9][ -]?[0-9]')", "rlike(text, '[0-9]{4}')"), "phone": ("contains(text, '+')", "rlike(text, '[0-9]{3}')")}

# Fixed values of the gazetteers and context lists.
TOP_DOMAINS = "com org net edu gov mil int info io co uk de fr es it nl eu ca au jp cn in br ru ch se no dk fi pl at be pt ie us biz dev app"
CUES = {
    "email": "email e-mail mail contact write courriel correo correo-e adresse address",
    "ip": "ip host server address from client addr login connected adresse",
    "card": "card visa mastercard amex credit debit carte karte tarjeta payment pan",
    "phone": "phone tel telephone call mobile cell fax contact whatsapp telefon téléphone teléfono appelez anrufen",
}
COUNTER = {
    "email": "token key hash",
    "ip": "version v ver release chapter section firmware build",
    "card": "isbn issn order invoice ref reference id serial doi token tracking number",
    "phone": "isbn issn order invoice ref reference id serial version page",
}
CONTEXT, VOTES, BLOCK = 24, 6, 128

# The expressions over a text are SQL: hundreds of nodes, built in one call.


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def total(xs: str) -> str:
    return f"aggregate({xs}, 0L, (a, x) -> a + x)"


def running(xs: str) -> str:
    """Sum of the lengths before each one, by sums of blocks: an array of n
    costs n * BLOCK + (n / BLOCK)^2 steps."""
    sums = f"transform(sequence(0, (size(xs) - 1) div {BLOCK}), b -> {total(f'slice(xs, CAST(b AS INT) * {BLOCK} + 1, {BLOCK})')})"
    heads = let("ss", sums, f"transform(ss, (q, b) -> {total('slice(ss, 1, b)')})")
    each = let("hs", heads, f"transform(xs, (q, i) -> get(hs, CAST(i div {BLOCK} AS INT)) + {total(f'slice(xs, i - i % {BLOCK} + 1, i % {BLOCK})')})")
    return let("xs", xs, f"IF(size(xs) = 0, CAST(array() AS ARRAY<BIGINT>), {each})")


def _matches(text: str, pattern: str) -> str:
    return f"named_struct('gaps', split({text}, r'{pattern}', -1), 'found', regexp_extract_all({text}, r'{pattern}', 0))"


def places(text: str, pattern: str) -> str:
    """Matches of ``pattern``: an array of (start, stop, span, before, after) in
    code points, with a little text on either side.  Matches and the text
    between them alternate, so places are running lengths."""
    step = ("transform(arrays_zip(t.gaps, t.found), z -> named_struct('gap', length(z.gaps), 'len', length(z.found), 'span', z.found, "
            f"'tail', substring(z.gaps, -{CONTEXT}, {CONTEXT}), 'head', substring(z.gaps, 1, {CONTEXT})))")
    spans = let("starts", running("transform(steps, s -> CAST(s.gap + coalesce(s.len, 0) AS BIGINT))"),
                "transform(slice(steps, 1, size(steps) - 1), (s, i) -> named_struct('start', get(starts, i) + s.gap, "
                "'stop', get(starts, i) + s.gap + s.len, 'span', s.span, 'before', s.tail, 'after', get(steps, i + 1).head))")
    return let("t", _matches(text, pattern), let("steps", step, spans))


def base_valid(kind: str, span: str) -> str:
    """The contract's test of a base match.  Lengths are looked at first, so a
    run of a million digits costs no sum."""
    digits = f"regexp_replace({span}, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": (f"forall(split({span}, r'\\.'), p -> IF(length(ltrim('0', p)) > 3, false, "
               "CAST(coalesce(nullif(ltrim('0', p), ''), '0') AS INT) <= 255))"),
        "card": f"IF(length({digits}) BETWEEN 12 AND 19, luhn_check({digits}), false)",
        "phone": f"(length({digits}) BETWEEN 9 AND 15)",
    }[kind]


def more_valid(kind: str, span: str) -> str:
    """The test of a further candidate: the kind's own, and for the kinds whose
    further pattern takes any number, a form that says what it is."""
    return {
        "email": rf"(rlike({span}, r'^[A-Za-z0-9][^@]*(@|[\[( ]at[\]) ]).*(\.|[\[( ]dot[\]) ])') AND {_top(span)})",
        "ip": f"(contains({span}, ':') OR (size(split({span}, r'\\.')) = 4 AND {base_valid('ip', span)}))",
        "card": base_valid("card", span),
        "phone": rf"({base_valid('phone', span)} AND rlike({span}, r'^(\+|00)[1-9]|^\([0-9]{{3}}\)|^[0-9]{{3}}[ .-][0-9]{{3}}[ .-][0-9]{{4}}$'))",
    }[kind]


def blanked(text: str, kind: str) -> str:
    """``text`` with its base spans filled up by a character that no pattern
    takes, so that all other places stay."""
    filled = f"coalesce(IF({base_valid(kind, 'z.found')}, repeat(chr(0), length(z.found)), z.found), '')"
    return let("t", _matches(text, BASE[kind]), f"array_join(transform(arrays_zip(t.gaps, t.found), z -> concat(z.gaps, {filled})), '')")


def _vote(yes: str, no: str | None = None) -> str:
    """2 for yes, 0 for no, 1 for neither; without ``no``, all that is not yes."""
    return f"IF({yes}, 2, 0)" if no is None else f"CASE WHEN {yes} THEN 2 WHEN {no} THEN 0 ELSE 1 END"


def _words(words: str) -> str:
    return r"(?:^|[^\p{L}])(?:" + "|".join(words.split()) + r")(?:[ .]{1,2}(?:no|nr|number|is))?[^\p{L}0-9]{0,8}$"


def _top(span: str) -> str:
    return f"rlike({span}, r'(?i)(?<![A-Z0-9])({'|'.join(TOP_DOMAINS.split())})$')"


def labelers(kind: str, valid: str) -> list[str]:
    """The six votes on a candidate ``c`` (span, before, after)."""
    form = {  # the whole span has a usual form
        "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,8}\.[A-Za-z]{2,24}$",
        "ip": r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})$",
        "card": r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})$",
        "phone": r"^(?:(?:\+|00)[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){1,4}$",
    }[kind]
    digits = "regexp_replace(c.span, '[^0-9]', '')"
    known = {  # gazetteers: top-level domains, unicast networks, card issuers, calling codes
        "email": _vote(_top("c.span"), "true"),
        "ip": _vote(r"rlike(c.span, r'^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.[0-9]+\.|^(?i:2[0-9a-f]{3}|fd[0-9a-f]{2}):')", r"rlike(c.span, r'^0*\.|^[0-9]+\.[0-9]+$')"),
        "card": _vote(f"rlike({digits}, r'^(?:4|5[1-5]|2[2-7]|3[47]|35|36|6011|65|62)')", f"rlike({digits}, r'^[01789]')"),
        "phone": _vote(r"rlike(c.span, r'^(?:\+|00)[1-9]')", r"rlike(c.span, r'^\+?0[^0]|^[0-9]+$')"),
    }[kind]
    sound = {  # no character that belongs to a longer token touches the span
        "email": "NOT rlike(c.before, r'[/:=@]$') AND NOT rlike(c.after, r'^[@/_]')",
        "ip": r"NOT rlike(c.before, r'[\p{L}0-9._/-]$') AND NOT rlike(c.after, r'^(?:[.-]?[\p{L}0-9]|_)')",
    }.get(kind, r"NOT rlike(c.before, r'[\p{L}0-9._$#/=\x22-]$') AND NOT rlike(c.after, r'^(?:[.,-]?[\p{L}0-9]|[_/=@\x22])')")
    plain = {  # no sign of a made-up or counted number
        "email": r"NOT rlike(c.span, r'\.\.|^[.@-]|[.-]@|@$')", "ip": "rlike(c.span, '[2-9]')",
    }.get(kind, rf"NOT rlike({digits}, r'^([0-9])\1+$|^0?1234567|^[0-9]{{0,5}}$')")
    cue = _vote(f"rlike(lower(c.before), r'{_words(CUES[kind])}')", f"rlike(lower(c.before), r'{_words(COUNTER[kind])}')")
    odd = r"NOT rlike(c.span, r'[\[( ]at[\]) ]')" if kind == "email" else None  # a written-out address has no usual form
    return [_vote(f"rlike(c.span, r'{form}')", odd), _vote(valid), known, cue, _vote(sound), _vote(plain)]


#: What the span classifier sees beside the votes.
FORM = ["rlike(c.span, '[ .-]')", r"rlike(c.span, r'[()+@\[]')", "length(c.span) >= 12", "length(c.span) >= 16"]


def candidates(kind: str) -> str:
    """All candidates of a kind in column ``text``: an array of (start, kind,
    stop, base, valid, code); ``code`` packs votes and form into one number."""
    def coded(spans: str, base: bool, valid: str) -> str:
        votes = " + ".join(f"{v} * {3 ** i}" for i, v in enumerate(map("({})".format, labelers(kind, "c.valid"))))
        form = " + ".join(f"CAST({b} AS INT) * {3 ** VOTES * 2 ** i}" for i, b in enumerate(FORM))
        tested = f"transform({spans}, c -> named_struct('start', c.start, 'stop', c.stop, 'span', c.span, 'before', c.before, 'after', c.after, 'valid', {valid}))"
        kept = f"filter({tested}, c -> c.valid)" if base else tested
        return (f"transform({kept}, c -> named_struct('start', c.start, 'kind', {KINDS.index(kind)}, 'stop', c.stop, "
                f"'base', {str(base).lower()}, 'valid', c.valid, 'code', {votes} + {form}))")

    none = "CAST(array() AS ARRAY<STRUCT<start: BIGINT, kind: INT, stop: BIGINT, base: BOOLEAN, valid: BOOLEAN, code: INT>>)"
    hint, more = HINT[kind]
    rest = let("rest", f"IF({hint}, {blanked('text', kind)}, text)", coded(places("rest", MORE[kind]), False, more_valid(kind, "c.span")))
    return (f"concat(IF({hint}, {coded(places('text', BASE[kind]), True, base_valid(kind, 'c.span'))}, {none}), IF({more}, {rest}, {none}))")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def on(code: Column) -> Column:
    """Numbers of the votes (0 to 17) and form marks (18 to 21) of a candidate."""
    vote = F.array(*(F.lit(3 * j) + F.floor(code / 3 ** j).cast("int") % 3 for j in range(VOTES)))
    form = [F.when(F.floor(code / (3 ** VOTES * 2 ** i)).cast("int") % 2 == 1, F.lit(3 * VOTES + i)) for i in range(4)]
    return F.concat(vote, F.array_compact(F.array(*form)))


def weigh(active: Column, weights: Column, bias: Column) -> Column:
    """Logistic score of the active marks."""
    sums = F.aggregate(active, bias, lambda a, k: a + F.coalesce(F.get(weights, k), F.lit(0.0)))
    return 1.0 / (1.0 + F.exp(-sums))


def reliabilities(rows: Column, rounds: int, strength: float) -> Column:
    """Expectation-maximisation over ``rows`` (an array of (on, n)): the share of
    personal data and how often each labeler votes what on it (``yes``) and on
    other text (``no``).  The labelers begin as better than chance, and
    ``strength`` rows' worth of that opinion is kept."""
    better, worse = [0.1, 0.3, 0.6] * VOTES, [0.6, 0.3, 0.1] * VOTES
    numbers = lambda xs: F.array(*map(F.lit, xs))
    begin = F.struct(F.lit(0.5).alias("share"), numbers(better).alias("yes"), numbers(worse).alias("no"))

    def share(g: Column, side: str, start: list[float]) -> Column:
        whole = F.aggregate(g, F.lit(strength), lambda a, p: a + p[side])
        return _let(whole, lambda w: F.transform(F.sequence(F.lit(0), F.lit(3 * VOTES - 1)), lambda k: (F.aggregate(
            g, F.lit(strength) * F.get(numbers(start), k), lambda a, p: a + F.when(F.array_contains(p["on"], k), p[side]).otherwise(0.0))) / w))

    def step(state: Column, _: Column) -> Column:
        post = _let(log_odds(state), lambda w: F.transform(rows, lambda p: _let(
            weigh(p["on"], w, F.log(state["share"]) - F.log(1.0 - state["share"])),
            lambda y: F.struct(p["on"].alias("on"), (p["n"] * y).alias("yes"), (p["n"] * (1.0 - y)).alias("no")))))
        return _let(post, lambda g: F.struct(
            ((1.0 + F.aggregate(g, F.lit(0.0), lambda a, p: a + p["yes"])) / (2.0 + F.aggregate(g, F.lit(0.0), lambda a, p: a + p["yes"] + p["no"]))).alias("share"),
            share(g, "yes", better).alias("yes"), share(g, "no", worse).alias("no")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, step)


def log_odds(state: Column) -> Column:
    return F.zip_with(state["yes"], state["no"], lambda y, n: F.log(y) - F.log(n))


def classifier(rows: Column, rounds: int, rate: float = 2.0, shrink: float = 1e-3) -> Column:
    """Logistic regression by gradient steps on ``rows`` (an array of (on, n,
    y)), ``y`` the posterior of the label model: (bias, weights).  Personal data
    and other text weigh the same as a whole, however rare either is."""
    begin = F.struct(F.lit(0.0).alias("bias"), F.array_repeat(F.lit(0.0), 3 * VOTES + 4).alias("weights"))
    sums = F.struct(F.aggregate(rows, F.lit(1.0), lambda a, p: a + p["n"] * p["y"]).alias("yes"),
                    F.aggregate(rows, F.lit(1.0), lambda a, p: a + p["n"] * (1.0 - p["y"])).alias("no"))
    shares = _let(sums, lambda s: F.transform(rows, lambda p: F.struct(
        p["on"].alias("on"), (p["n"] * p["y"] / s["yes"] / 2).alias("yes"), (p["n"] * (1.0 - p["y"]) / s["no"] / 2).alias("no"))))

    def step(state: Column, own: Column) -> Column:
        miss = F.transform(own, lambda p: F.struct(p["on"].alias("on"), (
            p["yes"] - (p["yes"] + p["no"]) * weigh(p["on"], state["weights"], state["bias"])).alias("d")))
        return _let(miss, lambda g: F.struct(
            (state["bias"] + rate * F.aggregate(g, F.lit(0.0), lambda a, p: a + p["d"])).alias("bias"),
            F.transform(state["weights"], lambda w, k: w * (1.0 - rate * shrink) + rate * F.aggregate(
                g, F.lit(0.0), lambda a, p: a + F.when(F.array_contains(p["on"], k), p["d"]).otherwise(0.0))).alias("weights")))

    return _let(shares, lambda own: F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, lambda s, _: step(s, own)))


def fit(found: DataFrame, rounds: int = 25, strength: float = 20.0, steps: int = 150) -> DataFrame:
    """One row per kind with candidates: ``labels`` (share, yes, no) of the label
    model and ``spans`` (bias, weights) of the classifier.  ``found`` has the
    column ``spans`` of ``candidates``; it is counted by kind and code, so each
    kind folds at most 3^6 * 2^4 rows."""
    counts = found.select(F.explode("spans").alias("c")).groupBy("c.kind", "c.code").agg(F.count("*").cast("double").alias("n"))
    rows = counts.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("code", on(F.col("code")).alias("on"), "n"))).alias("rows"))
    labels = rows.withColumn("labels", reliabilities(F.col("rows"), rounds, strength))
    soft = _let(log_odds(F.col("labels")), lambda w: F.transform("rows", lambda p: F.struct(p["on"].alias("on"), p["n"].alias("n"), weigh(
        F.slice(p["on"], 1, VOTES), w, F.log(F.col("labels.share")) - F.log(1.0 - F.col("labels.share"))).alias("y"))))
    return labels.select("kind", "labels", _let(soft, lambda r: classifier(r, steps)).alias("spans"))


def find_pii(docs: DataFrame, text_col: str = "text", cut: float = 0.9) -> DataFrame:
    """``row`` (a struct of all columns but the text) and ``spans``: an array of
    (start, kind, stop, base, score) by start, then kind; places are code
    points, the end exclusive.

    Base spans are those of the contract's patterns and tests, all kept, with
    score 1.  Added spans come from the looser patterns, pass the same test of
    their kind where it has one and score ``cut`` or more; spans of one kind
    never overlap.  Null and empty texts have no span.  Rows that repeat are
    treated alike and all returned; an empty table gives no row.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    src = docs.select(packed(docs, (text_col,)), text.alias("text"))
    found = parked(src.select("row", F.concat(*(F.expr(candidates(k)) for k in KINDS)).alias("spans")), "pii-spans")
    models = {r.kind: r.spans for r in fit(found).collect()}  # a few dozen numbers per kind
    zero = [0.0] * (3 * VOTES + 4)
    weights = F.array(*(F.array(*(F.lit(float(w)) for w in (models[k].weights if k in models else zero))) for k in range(len(KINDS))))
    bias = F.array(*(F.lit(float(models[k].bias) if k in models else -9.0) for k in range(len(KINDS))))
    scored = F.transform("spans", lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"), c["base"].alias("base"),
        F.when(c["base"], 1.0).when(~c["valid"], 0.0).otherwise(weigh(on(c["code"]), F.get(weights, c["kind"]), F.get(bias, c["kind"]))).alias("score")))
    return found.select("row", F.array_sort(F.filter(scored, lambda c: c["score"] >= cut)).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


# The label model has no SQL form; tests compare base spans and both models with brute force.
@query("op11_pii")
def op11_pii(spark, sf_dir):
    got = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    number = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return got.select("row.doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
