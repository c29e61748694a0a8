import pytest

from noticeloom.operators import boards as b
from noticeloom.operators.extract import extract_rows

NBSP = "\u00a0"
ONE = (
    '<div class="carousel"><li><a onclick="go_view(999)"><p class="tit">Featured</p></li></div>'
    '<ul id="bizPbancList"><li class="notice"><a href="javascript:go_view(101)">'
    '<span class="flag type02">A&amp;B</span><span class="flag day">D-7</span><p class="tit">Grant&nbsp;one</p>'
    '<span class="flag_agency">public</span><span class="list"><i class="x"></i>Prog</span>'
    '<span class="list"><i class="x"></i>Org</span><span class="list"><i></i>시작일자 2026-07-01</span>'
    '<span class="list"><i></i>마감일자 2026-07-18</span></li><li>no view</li></ul>'
)
TWO = (
    '<table><tr><th>no</th></tr><tr><td>9</td><td>Fund</td><td><a href="/sii/view.do?pblancId=PBLN_000000000001&amp;x=1">\n'
    "  Alpha&nbsp;&amp; Beta</a></td><td>2026-07-07 ~ 2026-07-17</td><td>Ministry</td><td></td><td>2026.07.01</td>"
    '<td>12</td></tr>\n<tr><td>8</td><td>Tech</td><td><a href="/sii/view.do?pblancId=PBLN_000000000002">Gamma</a></td>'
    "<td>상시</td></tr></table>"
)
THREE = (
    '<tr><td>3</td><td><a href="/home/2-2/777"><!-- new -->Voucher&amp;AI</a><span class="box blue">AI</span>'
    '<p>신청기간 : 2026.07.01 ~ 2026.07.20</p></td><td><span class="bco">2026-06-30</span>'
    '<span class="bco"> 2026-07-02 </span></td></tr>'
)
FOUR = (
    '<tr><td><span class="category_color3">Content</span></td><td><a href="/kocca/pims/view.do?intcNo=326X1&amp;menuNo=204104">'
    'Audio  grant</a></td><td data-label="공고일">26.07.01</td><td data-label="접수기간">26.07.10 ~ 26.07.24</td></tr>'
)
FIVE = (
    '<tr><td>Program</td><td>Field</td><td><a href="/front/ifg/no/notice02_detail.do;jsessionid=AB12.n1?ancmId=S0001&amp;buclCd=1">'
    "R&amp;D call</a></td><td>2026-07-01 ~ 2026-07-31</td><td>2026-06-25</td></tr>\n"
    '<tr><td>Program</td><td>Field</td><td><a href="/front/ifg/no/notice02_detail.do?ancmId=S0002">Other</a></td>'
    "<td>2026-07-01 ∼ 2026-07-31</td><td>2026-06-26</td></tr>"
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "source string, page_no int, status int, html string")


def rows(spark, spec, page):
    got = extract_rows(pages(spark, [(spec.source, 1, 200, page), (spec.source, 2, 503, page)]), spec)
    return [tuple(r) for r in got.drop("page_no", "pos").collect()]


def test_board_one(spark):
    assert rows(spark, b.KSTARTUP, ONE) == [(
        "101", "A&B", "D-7", f"Grant{NBSP}one", "Prog", "Org", "2026-07-01", "2026-07-18", "public",
        b.KSTARTUP_URL + "101",
    )]
    assert rows(spark, b.KSTARTUP, ONE.replace('id="bizPbancList"', "")) == []


def test_board_two(spark):
    assert rows(spark, b.BIZINFO, TWO) == [
        ("bizinfo", "PBLN_000000000001", "Alpha & Beta", "Fund", "Ministry", "2026-07-07", "2026-07-17",
         "2026.07.01", b.BIZINFO_URL + "PBLN_000000000001"),
        ("bizinfo", "PBLN_000000000002", "Gamma", "Tech", "", "", "상시", "", b.BIZINFO_URL + "PBLN_000000000002"),
    ]


def test_board_three(spark):
    assert rows(spark, b.NIPA, THREE) == [
        ("nipa", "777", "Voucher&AI", "AI", "NIPA", "2026-07-01", "2026-07-20", "2026-07-02",
         "https://www.nipa.kr/home/2-2/777"),
    ]
    bare = '<tr><td><a href="/home/2-2/5">T</a></td></tr>'
    assert rows(spark, b.NIPA, bare) == [("nipa", "5", "T", "", "NIPA", "", "", "", "https://www.nipa.kr/home/2-2/5")]


def test_board_four(spark):
    assert rows(spark, b.KOCCA, FOUR) == [
        ("kocca", "326X1", "Audio grant", "Content", "KOCCA", "2026-07-10", "2026-07-24", "2026-07-01",
         "https://www.kocca.kr/kocca/pims/view.do?intcNo=326X1&menuNo=204104"),
    ]


def test_board_five(spark):
    site = "https://www.smtech.go.kr/front/ifg/no/notice02_detail.do"
    assert rows(spark, b.SMTECH, FIVE) == [
        ("smtech", "S0001", "R&D call", "Field", b.SMTECH_ORG, "2026-07-01", "2026-07-31", "2026-06-25",
         site + "?ancmId=S0001&buclCd=1"),
        ("smtech", "S0002", "Other", "Field", b.SMTECH_ORG, "", "", "2026-06-26", site + "?ancmId=S0002"),
    ]


def test_all_boards_in_one_table(spark):
    table = pages(spark, [
        ("kstartup", 1, 200, ONE), ("bizinfo", 1, 200, TWO), ("nipa", 1, 200, THREE),
        ("kocca", 1, 200, FOUR), ("smtech", 1, 200, FIVE),
    ])
    got = b.extract_all(table)
    assert sorted((r.source, r.id) for r in got.collect()) == [
        ("bizinfo", "PBLN_000000000001"), ("bizinfo", "PBLN_000000000002"), ("kocca", "326X1"),
        ("kstartup", "101"), ("nipa", "777"), ("smtech", "S0001"), ("smtech", "S0002"),
    ]
    first = got.filter("source = 'kstartup'").first()
    assert (first.apply_end, first.apply_start, first.field) == ("2026-07-18", "2026-07-01", "A&B")
    assert first.dday and {"dday", "program", "agency_type"} <= set(got.columns)
    assert got.filter("source = 'nipa'").first().dday is None


@pytest.mark.parametrize("name", ["bizinfo", "smtech"])
def test_cells_of_a_block_are_cleaned_once(spark, name):
    """Fields take their texts from the cleaned array; none of them cleans the array again."""
    pages = spark.createDataFrame([(1, 200, "<table></table>")], "page_no int, status int, html string")
    plan = extract_rows(pages, b.BOARDS[name])._jdf.queryExecution().optimizedPlan().toString()
    assert "to_clean" not in plan.splitlines()[0]
    assert sum("to_clean" in line and "transform(coalesce(" in line for line in plan.splitlines()) == 1
