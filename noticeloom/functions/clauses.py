"""Whose region, time or sum is it? A text as clauses, each owned by its nearest cue.

A cue with a colon, or at the start of its part of a sentence, owns what follows ("문의: 서울",
"마감 7월 10일"); any other cue owns what stands before it ("14:00 설명회", "서울 소재"). A part without a
cue belongs to the cue before it, and a heading to the line below it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .text import let, mentions

# The cues of each role. A blank may also be missing, or be two.
CUES = {
    "applicant": (
        "신청 대상", "지원 대상", "모집 대상", "참여 대상", "참가 대상", "입주 대상", "신청 자격", "지원 자격", "참가 자격",
        "소재", "소재지", "거주", "예비 창업자",
    ),
    "reception": (
        "접수", "접수 기간", "접수 기한", "접수 방법", "접수 마감", "신청 기간", "신청 기한", "신청 방법", "모집 기간", "제출 기한",
        "마감", "마감일", "마감 일시", "마감 시간", "종료 일시", "종료 시간", "까지",
    ),
    "event": ("설명회", "발표 평가", "면접", "행사", "개최", "시상식", "간담회", "네트워킹", "오리엔테이션", "교육 일정", "교육 일시"),
    "contact": ("문의", "문의처", "연락처", "담당자", "담당 부서", "전화", "이메일", "팩스"),
    "venue": ("장소", "제출처", "접수처", "위치", "주소", "오시는 길", "행사장", "교육장"),
    "organiser": ("주최", "주관", "후원", "협력 기관", "운영 기관", "주관 기관"),
    "support": ("지원 내용", "지원 금액", "지원 규모", "지원 한도", "지원금", "최대", "한도"),
    "budget": ("총 사업비", "총 예산", "사업 예산", "자부담", "자기 부담", "민간 부담", "매출", "매출액", "투자 유치"),
    "documents": ("제출 서류", "구비 서류"),
}
ROLE_OF = {cue.replace(" ", ""): role for role, cues in CUES.items() for cue in cues}
BLANK = r"[ \t]{0,2}"
GROUP = 6


def _any_cue() -> str:
    """A pattern of all cues; the longest one at a place counts.

    Cues with the same first letter are one branch, and branches lie behind the range of their first
    letters, so that most places of a text are passed after a few comparisons.
    """
    heads: dict[str, list[str]] = {}
    for cue in sorted((c for cues in CUES.values() for c in cues), key=lambda c: -len(c)):
        heads.setdefault(cue[0], []).append(BLANK.join(map(re.escape, cue.split()))[1:])
    branches = [f"{head}(?:{'|'.join(rest)})" for head, rest in sorted(heads.items())]
    letters = sorted(heads)
    ranges = range(0, len(letters), GROUP)
    return "|".join(
        f"(?=[{letters[k]}-{letters[min(k + GROUP, len(letters)) - 1]}])(?:{'|'.join(branches[k:k + GROUP])})" for k in ranges)


ANY_CUE = _any_cue()
# Every cue is found once and marked; all further patterns look for the marks.
CUT, OPEN, CLOSE = "\x01", "\x02", "\x03"
CUE = f"{OPEN}[^{CLOSE}]*{CLOSE}"
# What may stand before a cue that begins its part: signs of a list, or its number.
BULLETS = r"(?:[\s○●■□▶※◦ㆍ·*(\[-]|\d{1,2}[.)])*+"
COLON = r"[ \t]*[:：]"
HEADING = rf"(?m)^({BULLETS}{CUE})(?:{COLON})?[ \t]*\n\s*"
SENTENCE_END = r"\n+|(?<!\d)[.。](?!\d)|[;；]"
# A comma ends a part only if the next part has a cue of its own.
PART_END = rf"[,，](?!\d)\s*(?=[^,，{CUT}{OPEN}]*{OPEN})"


def _cut(marked: Column) -> Column:
    return F.when(mentions(marked, CUT), F.split(marked, CUT)).otherwise(F.array(marked))


def _has_colon(text: Column) -> Column:
    return mentions(text, ":", "：")


def _pieces(part: Column) -> Column:
    """A part of a sentence, cut so that every piece has one owner."""

    def joined(cut: Column) -> Column:
        """What follows the last cue stays with it."""
        last, before = F.get(cut, F.size(cut) - 1), F.get(cut, F.size(cut) - 2)
        tail = F.array(F.concat(before, last))
        rest = (F.size(cut) > 1) & ~F.contains(last, F.lit(OPEN))
        return F.when(rest, F.concat(F.slice(cut, 1, F.greatest(F.size(cut) - 2, F.lit(0))), tail)).otherwise(cut)

    silent = ~mentions(part, OPEN)
    labelled = silent | (_has_colon(part) & part.rlike(rf"^{BULLETS}{CUE}{COLON}"))
    leading = part.startswith(OPEN) | part.rlike(rf"^{BULLETS}{OPEN}")
    before_cues = let(F.regexp_replace(part, f"({BULLETS}{OPEN})", f"{CUT}$1"), _cut)
    after_cues = let(let(F.replace(part, F.lit(CLOSE), F.lit(CLOSE + CUT)), _cut), joined)
    return F.when(labelled, F.array(part)).when(leading, before_cues).otherwise(after_cues)


def clauses(text: Column) -> Column:
    """array<struct<role, text>> in the order of the text; the role of a clause without a cue is ''.

    A null text has no clauses. Roles are those of CUES. The control characters U+0001 to U+0003 are
    taken out of the text.
    """
    roles = F.create_map(*[F.lit(x) for pair in ROLE_OF.items() for x in pair])
    given = F.coalesce(text, F.lit(""))
    bare = F.when(mentions(given, CUT, OPEN, CLOSE), F.regexp_replace(given, f"[{CUT}-{CLOSE}]+", "")).otherwise(given)
    marked = F.regexp_replace(bare, f"({ANY_CUE})", f"{OPEN}$1{CLOSE}")
    sentences = F.regexp_replace(F.regexp_replace(marked, HEADING, "$1: "), SENTENCE_END, CUT)
    parts = F.regexp_replace(sentences, PART_END, CUT)
    label = lambda t: F.when(
        _has_colon(t), F.regexp_replace(t, f"({BULLETS}{CUE}{COLON})", f"{CUT}$1")).otherwise(t)
    pieces = F.flatten(F.transform(let(let(parts, label), _cut), _pieces))

    def owned(piece: Column) -> Column:
        # Cues are marked in pairs: the first one ends at the first CLOSE and begins at the OPEN before it.
        first = F.substring_index(F.substring_index(piece, CLOSE, 1), OPEN, -1)
        cue = F.replace(F.replace(first, F.lit(" "), F.lit("")), F.lit("\t"), F.lit(""))
        role = F.when(mentions(piece, OPEN), F.try_element_at(roles, cue))
        bare = F.replace(F.replace(piece, F.lit(OPEN), F.lit("")), F.lit(CLOSE), F.lit(""))
        return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.trim(bare).alias("text"))

    return F.filter(F.transform(pieces, owned), lambda c: c["text"] != "")


def owned_by(found: Column, *roles: str) -> Column:
    """The clauses of some roles as lines."""
    return F.array_join(F.transform(F.filter(found, lambda c: c["role"].isin(*roles)), lambda c: c["text"]), "\n")


def not_owned_by(found: Column, *roles: str) -> Column:
    """The clauses of all other roles as lines."""
    return F.array_join(F.transform(F.filter(found, lambda c: ~c["role"].isin(*roles)), lambda c: c["text"]), "\n")
