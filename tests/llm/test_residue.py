import pytest

from conceptloom.llm.residue import contentless, open_slots, whole_text_reason

BODY = "The slow pendulum doubles the energy of the system. The cell wall hides the slope of the graph because the volume is fixed.\n\n"
SLOTS = "{{lesson}} {%block_x%} <%=topic%> <?=$topic?> ${author} #{teacher} {$unit} {unit_name} %TEACHER% %%topic%% @@SECTION@@ ::summary:: __COURSE_CODE__ <<topic>> <exam_date> [[next_unit]] [exam_date] [TBD]".split()
SLOTS += ["{{ name_of }}", "<%= topic %>", "{% block content %}{% endblock %}", "[INSERT TITLE HERE]", "[Your school name]", "[à compléter]", "[Titel einfügen]", "(insert topic)", "(name of the experiment)______", "[object Object]", "NaN%", "%s", "{0}", "[[image: TO ADD]]"]


@pytest.mark.parametrize("slot", SLOTS)
def test_open_slots(slot):
    assert open_slots(BODY + f"Dear {slot},\nwelcome to the course.\n" + BODY)
    assert open_slots(f"{slot}\n\n{BODY}")
    assert not open_slots(BODY + f"```\nprint {slot}\n```\n" + BODY)


@pytest.mark.parametrize(
    "prose",
    [
        "In template languages a slot such as {{ name }} is replaced by a value when the page is built.",
        "Printf-style formats like %s or {0} mark where an argument is inserted.",
        "Let A = {x | x > 0} and B = {{1}, {2}}; then \\frac{a}{b} with a in A is written ${a}/b$.",
        "Array index [i][j] and the interval [a, b] must not be mixed up; NaN means a result that is no number.",
        "[00:42] the slow pendulum [...] doubles the energy [music] by 5% or 10%, <b>twice</b>.",
        "def __init__(self): pass",
    ],
)
def test_discussed_slots(prose):
    assert not open_slots(BODY + prose + " " + BODY) and whole_text_reason(BODY + prose + " " + BODY) is None


@pytest.mark.parametrize(
    "text,reason",
    [
        ("Text goes here. " * 10, "filler"), ("blah " * 30, "filler"), ("asdf jkl " * 20, "filler"), ("Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "filler"),
        ("Heading\n\n" + "Kasa wugig fapigi gikapo zanefabo gebebi licuru rupebe pitiru cubofaf hozecico bajateg duluz peb vohu " * 2, "filler"),
        ("Coming soon. This lesson has not been written yet.\n\n(unit 3)", "notice"), ("Dieser Abschnitt ist noch leer. Inhalt folgt in Kürze.", "notice"),
        ("404 Not Found\n\nThe page could not be located on this server.\n\nHome | Courses | Help | Contact", "error"), ("页面不存在或已被删除，请返回首页。错误代码 404", "error"),
        ("Traceback (most recent call last):\n  File \"x.py\", line 3, in build\nKeyError: 'summary'", "error"),
        ("You need to enable JavaScript to run this app.", "script demand"), ("Veuillez activer JavaScript pour afficher cette leçon (5).", "script demand"),
        (BODY, None), ("Unit 3: Lens", None), ("", None), ("JavaScript is the language in which the browser part of this simulation is written; exercise two changes its loop.", None),
        (BODY * 3 + "A server answers 404 Not Found when no resource has the given address, and 502 when a gateway fails.", None),
    ],
)
def test_whole_texts(text, reason):
    assert whole_text_reason(text) == reason


def test_rows(spark):
    rows = [(1, None), (2, ""), (3, BODY), (4, "Coming soon."), (4, "Coming soon."), (5, BODY * 3000 + "{{ open_slot }}"), (6, "[TBD]")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, reason string, n_slots int")
    assert sorted((r.doc_id, r.reason) for r in contentless(df).collect()) == [(4, "notice"), (4, "notice"), (5, "slot"), (6, "slot")]
    assert contentless(df.filter("false")).count() == 0
