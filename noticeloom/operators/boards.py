"""The five boards as specs. Markup patterns and URL forms are values of the sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import norm_date, split_period
from ..functions.markup import cell, first_where, pick_prefix
from ..functions.text import drop_session, join_nonempty, strip_comments
from ..schemas import UNIFIED_FIELDS
from .extract import BoardSpec, Capture, extract_rows

# Markup of the list pages.
TABLE_ROW = r"<tr>(?s:.*?)</tr>"
LIST_MARKER = 'id="bizPbancList"'
LIST_ITEM = '<li class="notice">|<li >|<li>'
KSTARTUP_ID = r"(?U)go_view\((\d+)\)"
KSTARTUP_CATEGORY = r'(?U)<span class="flag type\d+">\s*([^<]+)</span>'
KSTARTUP_DDAY = r'(?U)<span class="flag day">\s*([^<]+)</span>'
KSTARTUP_TITLE = r'(?U)<p class="tit">\s*([^<]+)'
KSTARTUP_AGENCY = r'(?U)<span class="flag_agency">\s*([^<]+)</span>'
KSTARTUP_LIST = r'<span class="list"><i[^>]*></i>([^<]+)</span>'
KSTARTUP_START = "시작일자"
KSTARTUP_DEADLINE = "마감일자"
BIZINFO_LINK = (
    r'(?U)href\s*=\s*"([^"]*pblancId=(PBLN_\d+)[^"]*)"[^>]*>\s*((?s:.*?))</a>'
)
NIPA_LINK = r'(?U)href="(/home/2-2/(\d+))"[^>]*>((?s:.*?))</a>'
NIPA_PERIOD = r"(?U)신청기간\s*:\s*([^<]+)"
NIPA_PROGRAM = r'<span class="box[^"]*">([^<]+)</span>'
NIPA_REGISTERED = r'(?U)<span class="bco">\s*(\d{4}-\d{2}-\d{2})\s*</span>'
KOCCA_LINK = r'href="(/kocca/pims/view\.do\?intcNo=([^&"]+)[^"]*)"[^>]*>((?s:.*?))</a>'
KOCCA_CATEGORY = r'(?U)<span class="category_color\d+">([^<]+)</span>'
KOCCA_PERIOD = r'(?U)data-label="접수기간">\s*([^<]+)'
KOCCA_NOTICE = r'(?U)data-label="공고일">\s*([^<]+)'
SMTECH_LINK = (
    r'href="(/front/ifg/no/notice02_detail\.do[^"]*ancmId=([^&"]+)[^"]*)"[^>]*>((?s:.*?))</a>'
)
ISO_DATE = r"(?U)^\d{4}-\d{2}-\d{2}$"

# Detail URLs by source, the names of boards that publish their own calls.
KSTARTUP_URL = "https://www.k-startup.go.kr/web/contents/bizpbanc-ongoing.do?schM=view&pbancSn="
BIZINFO_URL = "https://www.bizinfo.go.kr/sii/siia/selectSIIA200Detail.do?pblancId="
NIPA_SITE = "https://www.nipa.kr"
KOCCA_SITE = "https://www.kocca.kr"
SMTECH_SITE = "https://www.smtech.go.kr"
NIPA_ORG = "NIPA"
KOCCA_ORG = "KOCCA"
SMTECH_ORG = "SMTECH(중소기업기술정보진흥원)"


def detail_url(source: Column, key: Column, path: Column) -> Column:
    """Absolute detail URL, from the id for two boards and from the link path for three."""
    return (
        F.when(source == "kstartup", F.concat(F.lit(KSTARTUP_URL), key))
        .when(source == "bizinfo", F.concat(F.lit(BIZINFO_URL), key))
        .when(source == "nipa", F.concat(F.lit(NIPA_SITE), path))
        .when(source == "kocca", F.concat(F.lit(KOCCA_SITE), path))
        .when(source == "smtech", F.concat(F.lit(SMTECH_SITE), drop_session(path)))
    )


def _kstartup(t: dict[str, Column]) -> dict[str, Column]:
    return {
        "pbancSn": t["id"],
        "category": t["category"],
        "dday": t["dday"],
        "title": t["title"],
        "program": cell(t["decoded_lists"], 0),
        "org": cell(t["decoded_lists"], 1),
        "start": pick_prefix(t["lists"], KSTARTUP_START),
        "deadline": pick_prefix(t["lists"], KSTARTUP_DEADLINE),
        "agency_type": t["agency_type"],
        "url": F.concat(F.lit(KSTARTUP_URL), t["id"]),
    }


def _unified(
    source: str, t: dict[str, Column], field: Column, org: Column, period: Column,
    reg_date: Column, path: Column,
) -> dict[str, Column]:
    span = split_period(period)
    values = (
        F.lit(source), t["id"], t["title"], field, org, span["apply_start"], span["apply_end"],
        reg_date, detail_url(F.lit(source), t["id"], path),
    )
    return dict(zip(UNIFIED_FIELDS, values, strict=True))


def _bizinfo(t: dict[str, Column]) -> dict[str, Column]:
    cells = t["cells"]
    org = F.when(F.size(cells) > 5, join_nonempty(F.slice(cells, 5, 2))).otherwise("")
    return _unified("bizinfo", t, cell(cells, 1), org, cell(cells, 3), cell(cells, 6), F.lit(""))


def _nipa(t: dict[str, Column]) -> dict[str, Column]:
    return _unified(
        "nipa", t, t["program"], F.lit(NIPA_ORG), t["period"],
        F.coalesce(F.try_element_at(t["registered"], F.lit(-1)), F.lit("")), t["path"],
    )


def _kocca(t: dict[str, Column]) -> dict[str, Column]:
    return _unified(
        "kocca", t, t["category"], F.lit(KOCCA_ORG), t["period"], norm_date(t["notice"]), t["path"]
    )


def _smtech(t: dict[str, Column]) -> dict[str, Column]:
    cells = t["cells"]
    return _unified(
        "smtech", t, cell(cells, 1), F.lit(SMTECH_ORG),
        first_where(cells, lambda c: c.contains("~")),
        first_where(cells, lambda c: c.rlike(ISO_DATE)), t["path"],
    )


KSTARTUP = BoardSpec(
    source="kstartup",
    region_marker=LIST_MARKER,
    block_delimiter=LIST_ITEM,
    anchor=KSTARTUP_ID,
    captures={
        "id": Capture(KSTARTUP_ID, mode="raw"),
        "category": Capture(KSTARTUP_CATEGORY, mode="late"),
        "dday": Capture(KSTARTUP_DDAY, mode="collapse"),
        "title": Capture(KSTARTUP_TITLE, mode="late"),
        "agency_type": Capture(KSTARTUP_AGENCY, mode="collapse"),
    },
    arrays={"lists": KSTARTUP_LIST},
    record=_kstartup,
)
BIZINFO = BoardSpec(
    source="bizinfo",
    block_pattern=TABLE_ROW,
    anchor=BIZINFO_LINK,
    captures={"id": Capture(BIZINFO_LINK, 2, "raw"), "title": Capture(BIZINFO_LINK, 3)},
    with_cells=True,
    record=_bizinfo,
)
NIPA = BoardSpec(
    source="nipa",
    block_pattern=TABLE_ROW,
    anchor=NIPA_LINK,
    captures={
        "id": Capture(NIPA_LINK, 2, "raw"),
        "path": Capture(NIPA_LINK, 1, "raw"),
        "title": Capture(NIPA_LINK, 3, before=strip_comments),
        "program": Capture(NIPA_PROGRAM),
        "period": Capture(NIPA_PERIOD, mode="raw"),
    },
    arrays={"registered": NIPA_REGISTERED},
    record=_nipa,
)
KOCCA = BoardSpec(
    source="kocca",
    block_pattern=TABLE_ROW,
    anchor=KOCCA_LINK,
    captures={
        "id": Capture(KOCCA_LINK, 2, "raw"),
        "path": Capture(KOCCA_LINK, 1, "decode"),
        "title": Capture(KOCCA_LINK, 3),
        "category": Capture(KOCCA_CATEGORY),
        "period": Capture(KOCCA_PERIOD, mode="raw"),
        "notice": Capture(KOCCA_NOTICE, mode="raw"),
    },
    record=_kocca,
)
SMTECH = BoardSpec(
    source="smtech",
    block_pattern=TABLE_ROW,
    anchor=SMTECH_LINK,
    captures={
        "id": Capture(SMTECH_LINK, 2, "raw"),
        "path": Capture(SMTECH_LINK, 1, "decode"),
        "title": Capture(SMTECH_LINK, 3),
    },
    with_cells=True,
    record=_smtech,
)
BOARDS = {spec.source: spec for spec in (KSTARTUP, BIZINFO, NIPA, KOCCA, SMTECH)}


def to_unified(board_one: DataFrame) -> DataFrame:
    """Board-one records keyed as in the unified table; fields it lacks are ''.

    The category is the field, the start the start of applications; its other fields are kept under
    their own names.
    """
    kept = [c for c in board_one.columns if c in ("run_id", "page_no", "pos")]
    present = {
        "source": F.lit("kstartup"), "id": F.col("pbancSn"), "title": F.col("title"),
        "org": F.col("org"), "apply_end": F.col("deadline"), "url": F.col("url"),
        "field": F.coalesce("category", F.lit("")), "apply_start": F.coalesce("start", F.lit("")),
    }
    own = [c for c in ("dday", "program", "agency_type") if c in board_one.columns]
    return board_one.select(
        *kept, *[present.get(n, F.lit("")).alias(n) for n in UNIFIED_FIELDS], *own
    )


def union_sources(*tables: DataFrame) -> DataFrame:
    """Results of several boards as one table; a field that a board lacks is null."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def extract_all(pages: DataFrame) -> DataFrame:
    """Unified records of all boards in a page table."""
    rows = [extract_rows(pages, spec) for name, spec in BOARDS.items() if name != "kstartup"]
    return union_sources(to_unified(extract_rows(pages, KSTARTUP)), *rows)
