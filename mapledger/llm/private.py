"""Personal data by weak supervision, in column functions only.

Base rules find emails, addresses, card and phone numbers; wider patterns propose further spans (telephone
numbers without a plus sign, keys and passwords). Four labelers vote on every candidate: a regex on its
shape, a gazetteer of endings, prefixes and ranges, the words before it, and its mix of characters.
Expectation-maximisation over the counts of vote patterns estimates how often each labeler is right, and the
resulting soft labels train a logistic span classifier. Only pattern counts reach the driver: at most
5 kinds * 3^4 votes * 12 shapes, whatever the data. Base spans always stay; a proposed span stays if the
classifier accepts it and no base span covers any of it.

Defined results: a null text reads as empty and has no spans. Offsets count code points, ends are exclusive.
Repeated rows are judged each for itself. Tables without candidates train nothing and add nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.llm.steps import staged

#: Kinds in the order of results; the last one has no base rule.
KINDS = ("email", "ip", "card", "phone", "secret")

# Patterns that find what the plain rule finds, leftmost first, in linear time: repetitions never give back
# characters, and a run of local or digit characters is entered at its start or behind the last match only.
_BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
              "instr(t, '@') > 0"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "digits"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "digits"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "digits AND instr(t, '+') > 0"),
}
_WIDE = {
    "phone": (r"(?<![0-9+(])(?<!\+[0-9]{1,3}[ .-]?)(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
              "digits"),
    "secret": (r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{12,}+",
               "digits"),
}

# What the gazetteer knows.
_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at")
_DIALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47",
             "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
             "86", "90", "91", "92", "93", "94", "95", "98")
_ISSUED = ("AKIA", "ASIA", "ghp_", "gho_", "glpat-", "sk-", "xoxb-", "xoxp-", "AIza")
_CUES = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address|from|login",
    "card": "card|visa|credit|payment|account",
    "phone": "tel|phone|call|mobile|fax|ring",
    "secret": "pass|passwd|password|token|secret|key|auth|bearer|credential",
}
_BEFORE = 24


def _raw(pattern: str) -> str:
    return "r'" + pattern + "'"


def _located(pattern: str, when: str) -> str:
    """Spans (s, e, m) of all matches: between them lie the pieces of a split by the same pattern."""
    r = _raw(pattern)
    return f"""
      aggregate(
        arrays_zip(
          CASE WHEN {when} THEN split(t, {r}, -1) ELSE cast(array() AS array<string>) END,
          CASE WHEN {when} THEN regexp_extract_all(t, {r}, 0) ELSE cast(array() AS array<string>) END),
        named_struct('at', 0, 'found', cast(array() AS array<struct<s:int,e:int,m:string>>)),
        (a, x) -> IF(x['1'] IS NULL, a, named_struct(
          'at', a.at + char_length(x['0']) + char_length(x['1']),
          'found', array_append(a.found, named_struct(
            's', a.at + char_length(x['0']), 'e', a.at + char_length(x['0']) + char_length(x['1']), 'm', x['1'])))),
        a -> a.found)"""


def _digits(text: str) -> str:
    return f"regexp_replace({text}, '[^0-9]', '')"


_LUHN = """
  aggregate(sequence(1, char_length(d)), 0, (sum, i) -> sum + IF(i % 2 = 1,
    cast(substring(d, char_length(d) - i + 1, 1) AS int),
    array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[cast(substring(d, char_length(d) - i + 1, 1) AS int)])) % 10 = 0"""

_VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> char_length(ltrim('0', p)) <= 3 AND cast(concat('0', right(ltrim('0', p), 3)) AS int) <= 255)",
    "card": f"exists(transform(array({_digits('x.m')}), d -> char_length(d) BETWEEN 16 AND 19 AND ({_LUHN})), ok -> ok)",
    "phone": f"char_length({_digits('x.m')}) BETWEEN 8 AND 15",
}


def _base_spans(kind: str) -> Column:
    pattern, when = _BASE[kind]
    return F.expr(f"filter({_located(pattern, when)}, x -> {_VALID[kind]})")


_SHAPE = {
    "email": "x.m RLIKE '^[A-Za-z0-9]'",
    "ip": "NOT x.m RLIKE '(^|[.])0[0-9]'",
    "card": f"char_length({_digits('x.m')}) = 16",
    "phone": f"char_length({_digits('x.m')}) BETWEEN 10 AND 13",
    "secret": "x.m RLIKE '^([0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z0-9]{20}|[A-Za-z0-9_/+-]{32,})$'",
}


def _any(values: tuple[str, ...]) -> str:
    return "|".join(values)


_GAZETTEER = {
    "email": f"IF(lower(x.m) RLIKE '[.]({_any(_ENDINGS)})$', 1, -1)",
    "ip": "IF(x.m RLIKE '^(0|10|127|192[.]168|169[.]254|22[4-9]|2[3-5][0-9])[.]', -1, 1)",
    "card": "IF(x.m RLIKE '^[3-6]', 1, -1)",
    "phone": f"IF(x.m RLIKE '^[+]({_any(_DIALLING)})', 1, IF(x.m LIKE '+%', -1, 0))",
    "secret": f"IF(x.m RLIKE '^({_any(_ISSUED)})', 1, IF(x.m RLIKE '^[a-z]+(-[a-z0-9]+)+$', -1, 0))",
}
_MIX = {
    "email": "IF(x.m RLIKE '^[^@]{1,64}@', 1, -1)",
    "ip": "IF(char_length(x.m) >= 8, 1, 0)",
    "card": "IF(x.m RLIKE '^([0-9]{16}|[0-9]{4}([ -])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4})$', 1, -1)",
    "phone": "IF(x.m RLIKE '[0-9]{15}', -1, 1)",
    "secret": f"IF(5 * char_length({_digits('x.m')}) BETWEEN char_length(x.m) AND 4 * char_length(x.m), 1, -1)",
}


def _judged(kind: str, spans: str, base: bool) -> str:
    """Candidates of one kind with their votes (1 yes, -1 no, 0 silent) and a shape class from 0 to 11."""
    cue = rf"(?i)({_CUES[kind]})[^A-Za-z0-9]{{0,6}}$"
    return f"""
      transform({spans}, x -> named_struct(
        'kind', {KINDS.index(kind)}, 'base', {str(base).lower()}, 's', x.s, 'e', x.e,
        'regex', IF({_SHAPE[kind]}, 1, -1), 'gazetteer', {_GAZETTEER[kind]},
        'context', IF(substring(t, greatest(x.s - {_BEFORE}, 0) + 1, least(x.s, {_BEFORE})) RLIKE {_raw(cue)}, 1, 0),
        'mix', {_MIX[kind]},
        'shape', 3 * CASE WHEN x.e - x.s < 14 THEN 0 WHEN x.e - x.s < 20 THEN 1 WHEN x.e - x.s < 32 THEN 2 ELSE 3 END
          + CASE WHEN 3 * char_length({_digits('x.m')}) < x.e - x.s THEN 0
                 WHEN 3 * char_length({_digits('x.m')}) < 2 * (x.e - x.s) THEN 1 ELSE 2 END))"""


def with_candidates(documents: DataFrame, name: str = "candidates") -> DataFrame:
    """Add every base span and every proposed span with its votes, in the order of kinds, then starts.

    The text is scanned once for each pattern; nothing is exchanged.
    """
    own = documents.columns
    text = documents.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.col("text"), F.lit("")).alias("t"))
    text = text.withColumn("digits", F.expr("t RLIKE '[0-9]'"))
    for kind in _BASE:
        text = text.withColumn(f"_base_{kind}", _base_spans(kind))
    for kind, (pattern, when) in _WIDE.items():
        text = text.withColumn(f"_wide_{kind}", F.expr(_located(pattern, when)))
    covered = "concat(" + ", ".join(f"_base_{k}" for k in _BASE) + ")"
    text = text.withColumn("_covered", F.expr(covered))
    parts = []
    for kind in KINDS:
        if kind in _BASE:
            parts.append(_judged(kind, f"_base_{kind}", True))
        if kind in _WIDE:
            free = f"filter(_wide_{kind}, w -> NOT exists(_covered, b -> b.s < w.e AND w.s < b.e))"
            parts.append(_judged(kind, free, False))
    found = F.expr("concat(" + ", ".join(parts) + ")")
    order = "array_sort({}, (l, r) -> CASE WHEN l.kind <> r.kind THEN l.kind - r.kind WHEN l.s <> r.s THEN l.s - r.s ELSE l.e - r.e END)"
    text = text.withColumn(name, found)
    return text.select(*[F.col(f"`{c}`") for c in own], F.expr(order.format(name)).alias(name))


_VOTES = ("regex", "gazetteer", "context", "mix")


@dataclass(frozen=True)
class SpanModel:
    """Logistic weights: a bias per kind, one weight per labeler, one per shape class."""

    kinds: tuple[float, ...]
    votes: tuple[float, ...]
    shapes: tuple[float, ...]
    reliability: dict[str, float]

    def accepts(self, x: str) -> str:
        """SQL: the classifier takes candidate `x` for personal data."""
        def looked_up(values: tuple[float, ...], index: str) -> str:
            return f"element_at(array({', '.join(f'{v!r}D' for v in values)}), {index} + 1)"

        votes = " + ".join(f"{w!r}D * {x}.{v}" for w, v in zip(self.votes, _VOTES, strict=True))
        return f"({looked_up(self.kinds, x + '.kind')} + {votes} + {looked_up(self.shapes, x + '.shape')}) >= 0D"


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def fit(candidates: DataFrame, name: str = "candidates", rounds: int = 40) -> SpanModel:
    """Labeler reliabilities by expectation-maximisation, then the classifier, from vote pattern counts."""
    counts = (
        candidates.select(F.explode(name).alias("x"))
        .groupBy("x.kind", "x.shape", *[f"x.{v}" for v in _VOTES]).agg(F.count(F.lit(1)).alias("n")).collect()
    )
    rows = sorted((r.kind, r.shape, tuple(r[v] for v in _VOTES), r.n) for r in counts)
    # A labeler is right with one probability per answer, shared by all kinds; each kind has its own prior.
    right = [{1: 0.8, -1: 0.8} for _ in _VOTES]
    prior = dict.fromkeys(range(len(KINDS)), 0.7)
    soft = [0.5] * len(rows)
    for _ in range(rounds if rows else 0):
        for i, (kind, _shape, votes, _n) in enumerate(rows):
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for v, known in zip(votes, right, strict=True):
                if v:
                    odds += v * math.log(known[v] / (1 - known[v]))
            soft[i] = _sigmoid(odds)
        for j, known in enumerate(right):
            for answer in (1, -1):
                hit = sum(r[3] * (p if answer > 0 else 1 - p) for r, p in zip(rows, soft, strict=True) if r[2][j] == answer)
                all_of = sum(r[3] for r in rows if r[2][j] == answer)
                known[answer] = min(0.98, max(0.52, (hit + 8) / (all_of + 10)))
        for kind in prior:
            own = [(r[3], p) for r, p in zip(rows, soft, strict=True) if r[0] == kind]
            prior[kind] = min(0.95, max(0.05, (sum(n * p for n, p in own) + 1) / (sum(n for n, _ in own) + 2)))
    weights = [0.0] * (len(KINDS) + len(_VOTES) + 12)
    total = sum(r[3] for r in rows) or 1
    for _ in range(400 if rows else 0):
        step = [0.0] * len(weights)
        for (kind, shape, votes, n), p in zip(rows, soft, strict=True):
            active = [(kind, 1.0), *((len(KINDS) + j, float(v)) for j, v in enumerate(votes)), (len(KINDS) + len(_VOTES) + shape, 1.0)]
            wrong = (_sigmoid(sum(weights[i] * x for i, x in active)) - p) * n / total
            for i, x in active:
                step[i] += wrong * x
        weights = [w - 2.0 * (g + 1e-4 * w) for w, g in zip(weights, step, strict=True)]
    cut = len(KINDS), len(KINDS) + len(_VOTES)
    return SpanModel(
        tuple(weights[: cut[0]]), tuple(weights[cut[0]: cut[1]]), tuple(weights[cut[1]:]),
        {f"{v}:{a}": k[a] for v, k in zip(_VOTES, right, strict=True) for a in (1, -1)},
    )


def _kept(model: SpanModel, name: str) -> str:
    return f"filter({name}, x -> x.base OR ({model.accepts('x')}))"


def _listed(spans: str) -> str:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.s, ':', x.e)), ',')"


def found(documents: DataFrame) -> DataFrame:
    """Per document: counts and digest of its base spans, and all spans.

    The candidates, not the texts, are staged once between training and use."""
    held = staged(with_candidates(documents.select("doc_id", "text")).select("doc_id", "candidates"), "spans")
    model = fit(held)
    base = "filter(candidates, x -> x.base)"
    return held.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(candidates, x -> x.base AND x.kind = {i})) AS bigint)").alias(f"n_{k}")
          for i, k in enumerate(KINDS) if k in _BASE],
        F.expr(f"sha2({_listed(base)}, 256)").alias("base_sha256"),
        F.expr(_listed(_kept(model, "candidates"))).alias("spans"),
    )


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with every span of their texts replaced by <KIND>; n_chars follows where it exists."""
    own = documents.columns
    model = fit(with_candidates(documents.select("text")))
    marks = "array(" + ", ".join(f"'<{k.upper()}>'" for k in KINDS) + ")"
    by_start = "array_sort(" + _kept(model, "_found") + ", (l, r) -> CASE WHEN l.s <> r.s THEN l.s - r.s ELSE r.e - l.e END)"
    clean = F.expr(f"""
      CASE WHEN size(_found) = 0 THEN text ELSE
      aggregate({by_start}, named_struct('at', 0, 'out', ''),
        (a, x) -> named_struct('at', greatest(a.at, x.e), 'out', concat(a.out,
          IF(x.s >= a.at, concat(substring(text, a.at + 1, x.s - a.at), {marks}[x.kind]), ''))),
        a -> concat(a.out, substring(text, a.at + 1))) END""")
    # A document's own columns travel in one, so that no name clashes.
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_own"), "text")
    changed = with_candidates(whole, "_found").withColumn("_clean", clean)
    columns = []
    for c in own:
        held = F.col("_own")[c]
        if c == "text":
            columns.append(F.col("_clean").alias("text"))
        elif c == "n_chars":
            kind = documents.schema[c].dataType
            same = F.col("_clean").eqNullSafe(F.col("text"))
            columns.append(F.when(same, held).otherwise(F.char_length("_clean").cast(kind)).alias(c))
        else:
            columns.append(held.alias(c))
    return changed.select(*columns)
