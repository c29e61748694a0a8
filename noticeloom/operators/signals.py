"""Eligibility signals from detail text. The rules are ours, versioned here as data.

Rules annotate, they never drop a row, and what no rule finds is 'unknown'. A text is cut into
clauses with an owner first (`functions/clauses.py`), so the address of a contact is no region of
applicants and the time of a briefing no closing time. It is read once per rule inside its own task;
nothing is joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clauses import clauses, not_owned_by, owned_by
from ..functions.text import let, mentions

RULES_VERSION = 3
UNKNOWN = "unknown"


@dataclass(frozen=True)
class SignalRule:
    """The first rule of a signal that matches gives its value.

    A text without any of `words` cannot match; without `words`, every text is searched.
    """

    signal: str
    value: str
    pattern: str
    scope: str = "eligibility"
    words: tuple[str, ...] = ()

    def found_in(self, views: dict[str, Column]) -> Column:
        view = views[self.scope]
        return mentions(view, *self.words) & view.rlike(self.pattern) if self.words else view.rlike(self.pattern)


# Which clauses a rule reads, by their owners: these only, or all but these.
NOT_APPLICANTS = ("contact", "venue", "organiser", "event")
SCOPES = {
    "eligibility": lambda found: not_owned_by(found, *NOT_APPLICANTS),
    "right": lambda found: owned_by(found, "applicant", "reception", ""),
    "location": lambda found: owned_by(found, "applicant"),
    "closing": lambda found: owned_by(found, "reception"),
    "sum": lambda found: owned_by(found, "support"),
    "other sum": lambda found: owned_by(found, "applicant", ""),
    "turnover": lambda found: owned_by(found, "budget", "applicant", ""),
}
# What a text must say, most specific rule first.
SIGNAL_RULES = (
    SignalRule("pre_founder", "no", r"예비\s*창업자(?:는|의 경우)?\s*(?:제외|불가|신청\s*불가)", words=("예비",)),
    SignalRule("pre_founder", "yes", r"예비\s*창업자(?:\s*(?:포함|및|가능|또는)|[,.])?", words=("예비",)),
    SignalRule("pre_founder", "no", r"사업자등록증|4대\s*보험|재무제표", words=("사업자등록증", "4대", "재무제표")),
    SignalRule("apply_region", "nationwide", r"전국", "right", ("전국",)),
    SignalRule("location_rule", "non_capital", r"비수도권", "right", ("비수도권",)),
    SignalRule("location_rule", "capital", r"수도권\s*(?:소재|지역)", "right", ("수도권",)),
    SignalRule("location_rule", "local", r"(?:관내|도내|시내)\s*소재", "right", ("소재",)),
    SignalRule("space", "yes", r"입주\s*공간|사무\s*공간|입주\s*지원", words=("입주", "사무")),
    SignalRule("exclusion", "duplicate_benefit", r"중복\s*(?:수혜|지원)\s*(?:불가|금지|제외)", words=("중복",)),
    SignalRule("exclusion", "graduates", r"수료(?:자|기업)\s*제외", words=("수료",)),
    SignalRule("trigger", "investment", r"투자\s*유치", words=("투자",)),
    SignalRule("trigger", "sales", r"매출(?:액)?\s*(?:\d|실적|이상)", words=("매출",)),
    SignalRule("trigger", "incorporation", r"법인\s*설립", words=("법인",)),
    SignalRule("trigger", "relocation", r"(?:본사|사업장)\s*이전", words=("이전",)),
)
REGIONS = (
    "서울", "부산", "대구", "인천", "광주", "대전", "울산", "세종", "경기", "강원",
    "충북", "충남", "전북", "전남", "경북", "경남", "제주",
)
# Provinces whose long name does not begin with the short one.
LONG_REGIONS = {
    "충청북도": "충북", "충청남도": "충남", "전라북도": "전북", "전북특별자치도": "전북", "전라남도": "전남",
    "경상북도": "경북", "경상남도": "경남",
}
CAPITAL_AREA = ("서울", "인천", "경기")
# Signals of which a text can have several.
MANY = ("exclusion", "trigger")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE = r"\b0\d{1,2}-\d{3,4}-\d{4}\b"
# Words that begin with the name of a region and name none.
NOT_REGIONS = {
    "경기": ("침체", "불황", "회복", "부양", "변동", "악화", "둔화", "위축", "전망", "호황", "상황", "장"),
    "부산": ("물",), "세종": ("대왕", "문화"), "대전": ("료", "상대"), "대구": ("탕",),
}
CLOCK = r"(?<!\d)((?:[01]?\d|2[0-3]):[0-5]\d)(?!\d)"
# Of the clauses on reception, one that speaks of the end counts before others; its last time does.
CLOSING = r"마감|까지|종료|기한"
DURATION = r"(?:지원|협약|사업|수행|입주)\s*기간[^\n.\d]{0,12}(\d{1,2})\s*개월"
BOUND_WORDS = "이내|이하|미만|이상|초과"
COMPANY_YEARS = (
    rf"(?:창업|설립|업력)\s*(?:후|한\s*지)?\s*(\d{{1,2}})\s*년\s*({BOUND_WORDS})"
    rf"(?:\s*(?:[~∼-]|부터)?\s*(\d{{1,2}})\s*년\s*({BOUND_WORDS}))?"
)
# A number is taken whole (possessive), so that a text full of digits costs one pass.
AMOUNT = (
    r"(?<![\d,.])(?=\d)(?:(\d[\d,]*+(?:\.\d++)?+)\s*+억)?+\s*+(?:(\d[\d,]*+)\s*+천\s*+만)?+"
    r"\s*+(?:(\d[\d,]*+)\s*+백\s*+만)?+\s*+(?:(\d[\d,]*+)\s*+만)?+\s*+(\d[\d,]*+)?+\s*+원"
)
TURNOVER = rf"매출(?:액)?[^\d\n]{{0,12}}({AMOUNT})\s*({BOUND_WORDS})"
AMOUNT_UNITS = (100_000_000, 10_000_000, 1_000_000, 10_000, 1)
ATTACHMENT = r"첨부\s*파일|붙임|HWP|hwp|PDF|pdf"
SHORT_BODY = 300
SIGNALS = tuple(dict.fromkeys(r.signal for r in SIGNAL_RULES))


def amount(text: Column) -> Column:
    """First sum of money in the text as whole won; null where there is none."""
    return let(_extract(text, AMOUNT, 0, "원"), _won)


def _extract(text: Column, pattern: str, group: int, *words: str) -> Column:
    """`regexp_extract` with a pattern that needs one of some words; texts without them are not searched."""
    return F.when(mentions(text, *words), F.regexp_extract(text, pattern, group)).otherwise("")


def _won(found: Column) -> Column:
    won = F.lit(0).cast("decimal(18,0)")
    for group, unit in enumerate(AMOUNT_UNITS, start=1):
        digits = F.replace(F.regexp_extract(found, AMOUNT, group), F.lit(","), F.lit(""))
        won = (won + F.coalesce(_number(digits), F.lit(0)) * unit).cast("decimal(18,0)")
    return F.when(found != "", won)


def _number(digits: Column) -> Column:
    # An empty text is no number; to find that out by a cast costs an exception.
    return F.when(digits != "", digits.try_cast("decimal(14,4)"))


def evidence(text: Column, pattern: str, scope: Column | None = None) -> Column:
    """The sentence of a text in which a pattern is found; the match itself where it spans two.

    With `scope`, the clauses that count, the match is looked for in them.
    """
    match = F.regexp_extract(text if scope is None else scope, pattern, 0)

    def sentence(m: Column) -> Column:
        inside = F.filter(F.split(text, r"[.\n]+"), lambda s: F.contains(s, m))
        return F.trim(F.coalesce(F.get(inside, F.lit(0)), m))

    return let(match, sentence)


def _scoped(text: Column, body: Callable[[dict[str, Column]], Column], scopes: tuple[str, ...] = tuple(SCOPES)) -> Column:
    """`body` of the clauses of each of `scopes` as text; the text is cut once."""
    views = lambda found: F.struct(*[SCOPES[name](found).alias(name) for name in scopes])
    return let(let(clauses(text), views), lambda v: body({name: v[name] for name in scopes}))


def _hit(signal: str, rules: tuple[SignalRule, ...], text: Column, views: dict[str, Column]) -> Column:
    """Structs (signal, value, evidence): of the first rule that matches, or of all for MANY."""

    def found(value: str, proof: Column) -> Column:
        return F.struct(F.lit(signal).alias("signal"), F.lit(value).alias("value"), proof.alias("evidence"))

    own = [
        F.when(r.found_in(views), found(r.value, evidence(text, r.pattern, views[r.scope])))
        for r in rules if r.signal == signal
    ]
    nothing = found(UNKNOWN, F.lit(""))
    if signal not in MANY:
        return F.array(F.coalesce(*own, nothing))
    hits = F.filter(F.array(*own), lambda h: h.isNotNull())
    return F.when(F.size(hits) == 0, F.array(nothing)).otherwise(hits)


def _value(signal: str, rules: tuple[SignalRule, ...], views: dict[str, Column]) -> Column:
    """The value of the first rule that matches, or the values of all for MANY."""
    own = [F.when(r.found_in(views), F.lit(r.value)) for r in rules if r.signal == signal]
    if signal not in MANY:
        return F.coalesce(*own, F.lit(UNKNOWN))
    return F.array_distinct(F.filter(F.array(*own), lambda v: v.isNotNull()))


def extract_signals(
    details: DataFrame, rules: tuple[SignalRule, ...] = SIGNAL_RULES,
    signals: tuple[str, ...] | None = None,
) -> DataFrame:
    """(source, id, signal, value, evidence, rules_version): every signal of every text.

    Signals of MANY have a row per value found, others one row. What is not found is 'unknown'.
    """
    text = F.coalesce("text", F.lit(""))
    names = signals or tuple(dict.fromkeys(r.signal for r in rules))
    read = tuple(dict.fromkeys(r.scope for r in rules if r.signal in names)) or ("eligibility",)
    hits = _scoped(text, lambda views: F.concat(*[_hit(s, rules, text, views) for s in names]), read)
    return details.select("source", "id", F.explode(hits).alias("hit")).select(
        "source", "id", "hit.*", F.lit(RULES_VERSION).alias("rules_version")
    )


def closing_time(reception: Column) -> Column:
    """The last time of the clauses on reception that say when it ends, else of any; '' without one."""
    lines = F.filter(F.split(reception, "\n"), lambda s: s.rlike(CLOCK))
    ends = F.filter(lines, lambda s: s.rlike(CLOSING))
    line = F.coalesce(F.get(ends, F.lit(0)), F.get(lines, F.lit(0)))
    return F.coalesce(F.regexp_extract(line, rf"(?s)^.*{CLOCK}", 1), F.lit(""))


def _bounds(pairs: list[tuple[Column, Column]]) -> Column:
    """An interval in brackets, `[3,7)`, from numbers and the words of their bounds; null without."""
    low, high = F.lit(None).cast("string"), F.lit(None).cast("string")
    for number, word in reversed(pairs):
        given = number.isNotNull() & (number != "")
        low = F.when(given & (word == "이상"), F.concat(F.lit("["), number)).when(
            given & (word == "초과"), F.concat(F.lit("("), number)).otherwise(low)
        high = F.when(given & word.isin("이내", "이하"), F.concat(number, F.lit("]"))).when(
            given & (word == "미만"), F.concat(number, F.lit(")"))).otherwise(high)
    known = low.isNotNull() | high.isNotNull()
    return F.when(known, F.concat_ws(",", F.coalesce(low, F.lit("(")), F.coalesce(high, F.lit(")"))))


def company_years(text: Column) -> Column:
    """Bounds on the age of a company as an interval, e.g. `(,3]` for up to and `(,3)` for less than 3."""

    def read(found: Column) -> Column:
        parts = F.struct(*[F.regexp_extract(found, COMPANY_YEARS, k).alias(f"p{k}") for k in range(1, 5)])
        return let(parts, lambda p: _bounds([(p["p1"], p["p2"]), (p["p3"], p["p4"])]))

    return let(_extract(text, COMPANY_YEARS, 0, "년"), lambda m: F.when(m != "", read(m)))


def _upper(interval: Column) -> Column:
    """The upper number of an interval, closed or not."""
    return _number(F.regexp_extract(interval, r",(\d+)[\])]$", 1)).cast("int")


def turnover(text: Column) -> Column:
    """Bounds on the turnover in won as an interval."""

    def read(found: Column) -> Column:
        parts = F.struct(
            _won(F.regexp_extract(found, TURNOVER, 1)).cast("string").alias("won"),
            F.regexp_extract(found, TURNOVER, 2 + len(AMOUNT_UNITS)).alias("word"))
        return let(parts, lambda p: _bounds([(p["won"], p["word"])]))

    return let(_extract(text, TURNOVER, 0, "매출"), lambda m: F.when(m != "", read(m)))


def signals_wide(
    details: DataFrame, rules: tuple[SignalRule, ...] = SIGNAL_RULES
) -> DataFrame:
    """One row per text: a column per signal, and the values that are read, not judged.

    Signals of MANY are arrays of all values found. Everything is read in the clauses that own it:
    `amount` where support is described, else where nothing else owns the sum; `close_time` where
    reception is; `regions` are those that applicants have to be in. `years` and `sales` are intervals,
    `max_years` is the number of the upper bound alone.
    """
    text = F.coalesce("text", F.lit(""))
    names = tuple(dict.fromkeys(r.signal for r in rules))

    def read(views: dict[str, Column]) -> Column:
        return F.struct(
            *[_value(s, rules, views).alias(s) for s in names],
            F.coalesce(amount(views["sum"]), amount(views["other sum"])).alias("amount"),
            _number(_extract(views["eligibility"], DURATION, 1, "기간")).cast("int").alias("months"),
            let(company_years(views["eligibility"]), lambda y: F.struct(
                _upper(y).alias("max_years"), y.alias("years"))).alias("age"),
            turnover(views["turnover"]).alias("sales"),
            closing_time(views["closing"]).alias("close_time"),
            regions_in(views["location"]).alias("regions"),
        )

    return details.select("source", "id", _scoped(text, read).alias("r"), text.alias("t")).select(
        "source", "id", *[f"r.{c}" for c in (*names, "amount", "months")], "r.age.max_years", "r.age.years",
        *[f"r.{c}" for c in ("sales", "close_time", "regions")], attachment_only(F.col("t")).alias("attachment_only"),
        F.lit(RULES_VERSION).alias("rules_version"),
    )


def attachment_only(text: Column, short: int = SHORT_BODY) -> Column:
    """A short body that refers to a file."""
    return (F.char_length(text) < short) & text.rlike(ATTACHMENT)


def named_regions(details: DataFrame, regions: tuple[str, ...] = REGIONS) -> DataFrame:
    """(source, id, region): every region a text names, by short or long name, in whatever role."""
    return details.select("source", "id", F.explode(regions_in(F.col("text"), regions)).alias("region"))


def regions_by_role(details: DataFrame) -> DataFrame:
    """(source, id, role, region): the regions named in the clauses of each role ('' without one)."""

    def named(clause: Column) -> Column:
        return F.transform(regions_in(clause["text"]), lambda r: F.struct(clause["role"].alias("role"), r.alias("region")))

    found = F.array_distinct(F.flatten(F.transform(clauses(F.col("text")), named)))
    return details.select("source", "id", F.explode(found).alias("f")).select("source", "id", "f.*")


def regions_in(text: Column, regions: tuple[str, ...] = REGIONS) -> Column:
    """Short names of the regions in a text. The lists are fixed and small.

    A name begins a word, and words like '경기 침체' name no region.
    """
    others = {name: "|".join(words) for name, words in NOT_REGIONS.items()}
    names = [*LONG_REGIONS, *[rf"{r}(?!\s*(?:{others[r]}))" if r in others else r for r in regions]]
    found = F.regexp_extract_all(text, F.lit(rf"(?<![가-힣])({'|'.join(names)})"), F.lit(1))

    # One lookup: a chain of conditions on the name so far doubles with every long name.
    own = F.create_map(*[F.lit(x) for pair in LONG_REGIONS.items() for x in pair])

    def short(name: Column) -> Column:
        return F.coalesce(F.try_element_at(own, name), name)

    return F.array_distinct(F.transform(found, short))


def contacts(details: DataFrame) -> DataFrame:
    """(source, id, kind, contact): phone numbers and mail addresses, each once per text."""
    def each(kind: str, pattern: str) -> Column:
        values = F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        return F.transform(
            values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("contact"))
        )

    found = F.concat(each("phone", PHONE), each("email", EMAIL))
    return details.select("source", "id", F.explode(found).alias("hit")).select("source", "id", "hit.*")


def fill_unknown(candidates: DataFrame, known: DataFrame, signals: tuple[str, ...]) -> DataFrame:
    """Every expected signal for every candidate; what `known` lacks is 'unknown'.

    `known` has (source, id, signal, value). The signal list is a literal array.
    """
    wanted = candidates.select(
        "source", "id", F.explode(F.array(*[F.lit(s) for s in signals])).alias("signal")
    )
    return wanted.join(known, ["source", "id", "signal"], "left").withColumn(
        "value", F.coalesce("value", F.lit(UNKNOWN))
    )
