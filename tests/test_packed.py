import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyweave.operators.packed import NOTATIONS, split_packed, tokens

CASES = [
    ("currency", "EUR|GHS", ["EUR", "GHS"]),
    ("currency", "EUR US Dollar", ["EUR US Dollar"]),
    ("currency", "US Dollar", ["US Dollar"]),
    ("currency", "EUR MYR RM", ["EUR", "MYR", "RM"]),
    ("currency", "EUR/US Dollar//€", ["EUR", "US Dollar", "€"]),
    ("currency", "USD +  +GHS + $", ["USD", "GHS", "$"]),
    ("currency", "['GBP', 'US Dollar']", ["GBP", "US Dollar"]),
    ("currency", '{"EUR","$"}', ["EUR", "$"]),
    ("currency", ";EUR;;  ;", ["EUR"]),
    ("number", "2022/9441 / NC 2023A/305 /  / \"K46854;1\"", ["2022/9441", "NC 2023A/305", "K46854;1"]),
    ("number", '"Ser. ""A"" 26513"|\'No|69907\'|«Z1;8»', ['Ser. "A" 26513', "No|69907", "Z1;8"]),
    ("number", "R-10551, ,26894,79726", ["R-10551", "26894", "79726"]),
    ("number", '["a\\"b", "c"]', ['a"b', "c"]),
    ("date", "Nov 6, 2023; 2. Dezember 2023;29/11/2023", ["Nov 6, 2023", "2. Dezember 2023", "29/11/2023"]),
    ("date", "3/29/24 2024-04-07  01.03.24", ["3/29/24", "2024-04-07", "01.03.24"]),
    ("date", '2024-05-14, "Apr 16, 2024", 14.04.24', ["2024-05-14", "Apr 16, 2024", "14.04.24"]),
    ("date", "28. Januar 2026", ["28. Januar 2026"]),
    ("number", 'it"s|«open|(x', ['it"s', "«open", "(x"]),
    ("number", '""|" "', []),
]


@pytest.mark.parametrize(("kind", "text", "want"), CASES)
def test_cases(kind, text, want):
    assert tokens(text, NOTATIONS[kind]) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab1 ;|,\"x", min_size=1, max_size=8).map(str.strip).filter(bool), min_size=1, max_size=6))
def test_quoted_round_trip(values):
    packed = "|".join('"' + v.replace('"', '""') + '"' for v in values)
    assert tokens(packed, NOTATIONS["number"]) == values


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text_is_read(text):
    for n in NOTATIONS.values():
        assert all(v and v == v.strip() for v in tokens(text, n))


def test_long_text_is_linear():
    assert len(tokens("«a|" * 60_000, NOTATIONS["number"])) == 60_000


def test_frame(spark):
    rows = [(1, "EUR|GHS", None, "x"), (1, "EUR|GHS", None, "x"), (2, None, "", "y"), (None, "USD", "A-1,B-2", "z")]
    df = spark.createDataFrame(rows, "inventory_id long, c string, n string, item_value string")
    got = sorted(map(tuple, split_packed(df, "inventory_id", {"c": "currency", "n": "number"}).collect()), key=str)
    assert got == sorted([(1, "c", 1, "EUR"), (1, "c", 2, "GHS")] * 2 + [(None, "c", 1, "USD"), (None, "n", 1, "A-1"), (None, "n", 2, "B-2")], key=str)
    assert split_packed(df.limit(0), "inventory_id", {"c": "currency"}).count() == 0
