from __future__ import annotations

import datetime
import json
from decimal import Decimal

import pandas as pd
import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.functions import patterns
from docloom.functions.patterns import need_of
from docloom.operators import extraction as ex
from docloom.schemas import EXTRACTION_RESULTS
from docloom.sources.pages import extraction_items, page_items, read_pages

DOCUMENT = {
    "id": 1, "organization_id": "org", "name": "invoice.pdf", "status": "ready", "is_valid": True,
    "created_at": "2026-05-29T00:00:00Z", "has_active_workflow": False,
}


@pytest.fixture()
def results(spark, tmp_path):
    """results({doc: [item, …]}) -> result table, read from a page dump."""
    counter = iter(range(1000))

    def make(items: dict[int, list[dict]]):
        docs = [{**DOCUMENT, "id": i, "extraction_results": rows} for i, rows in items.items()]
        page = {"items": docs, "page": 1, "page_size": 50, "has_more": False}
        path = tmp_path / f"page{next(counter)}.json"
        path.write_text(json.dumps(page) + "\n")
        return extraction_items(page_items(read_pages(spark, str(path))), EXTRACTION_RESULTS)

    return make


def item(prompt: int, name: str | None, parsed=None, **fields):
    return {"prompt_id": prompt, "value": {"name": name, "parsed_value": parsed, **fields}}


def test_full_item_is_read(results):
    row = results({1: [item(5, "Total", 1234.5, data_type="Number", display_type="currency",
        group_name="Financials", raw_value="$1,234.50", issues=[], readability=0.9,
        traceback=[{"bbox": {"Top": 0.1, "Left": 0.2, "Width": 0.3, "Height": 0.05}, "page": 2,
                    "confidence": 0.98, "issues": []}])]}).first()
    assert (row["prompt_id"], row["data_type"], row["display_type"]) == (5, "Number", "currency")
    assert (row["raw_value"], row["group_name"], row["readability"]) == ("$1,234.50", "Financials", 0.9)
    trace = row["traceback"][0]
    assert (trace["page"], trace["confidence"]) == (2, 0.98)
    assert tuple(trace["bbox"]) == (0.1, 0.2, 0.3, 0.05)


def test_typed_fields_keep_precision(results):
    rows = results({1: [
        item(5, "Royalty", 0.125, data_type="Number", value_number="0.12345678901234567890123", raw_value="1/8"),
        item(6, "Effective Date", "2024-02-29", data_type="Date", value_date="2024-02-29", raw_value="02/29/2024"),
        item(7, "Has Pugh", data_type="Boolean", value_bool=False, raw_value="No"),
        item(8, "Executed Date", data_type="Date", raw_value="Not Found"),
    ]})
    got = {r["prompt_id"]: r for r in ex.with_value_type(rows).collect()}
    assert got[5]["value_number"] == Decimal("0.12345678901234567890123")
    assert got[5]["value"] == "0.12345678901234567890123"
    assert got[6]["value_date"] == datetime.date(2024, 2, 29)
    assert got[7]["value_bool"] is False and got[7]["value_type"] == "bool"
    assert got[8]["value_type"] is None and got[8]["raw_value"] == "Not Found"


def test_legacy_value_counts_only_without_typed_field(results):
    rows = results({1: [item(5, "a", 1234.5, data_type="Number"), item(6, "b", 1.0, value_text=""),
                        item(7, "c", None)]})
    got = {r["prompt_id"]: (r["value_type"], r["value"]) for r in ex.with_value_type(rows).collect()}
    assert got == {5: ("parsed", "1234.5"), 6: ("text", ""), 7: (None, None)}


def test_flatten_by_name_falls_back_to_id(results):
    rows = results({1: [item(5, "Total", 1234.5), item(6, "Vendor", "ACME")],
                    2: [item(5, "Total", 9.0), item(6, None, True)]})
    flat = ex.flatten_values(rows)
    assert tuples(flat, "document_id", "key_kind", "field_key", "value") == sorted([
        (1, "name", "Total", "1234.5"), (1, "name", "Vendor", "ACME"),
        (2, "name", "Total", "9"), (2, "prompt_id", "6", "true")], key=repr)


def test_collision_is_an_error_by_name_only(results):
    rows = results({1: [item(5, "Total", 1.0), item(6, "Total", 2.0)]})
    with pytest.raises(Exception, match="Total appears 2 times on document 1; flatten with key_by='prompt_id'"):
        ex.flatten_values(rows, strict=True).count()
    flat = ex.flatten_values(rows, key_by="prompt_id", strict=True)
    assert tuples(flat, "field_key", "value") == [("5", "1"), ("6", "2")]
    assert tuples(ex.key_collisions(ex.with_field_key(rows)), "field_key", "items") == [("Total", 2)]


def test_prompt_named_like_an_id_is_another_field(results):
    rows = results({1: [item(5, "6", "named"), item(6, None, "unnamed")]})
    flat = ex.flatten_values(rows, strict=True)
    wide = ex.pivot_values(flat, ex_fields(flat)).first()
    assert (wide["6"], wide["6#id"]) == ("named", "unnamed")


def ex_fields(flat):
    return ex.field_columns(flat)


def test_pending_items_are_left_out_before_collisions(results):
    rows = results({1: [
        item(5, "Total", is_processing=True),
        item(6, "Vendor", raw_value="ACME", value_text="ACME", is_processing=True),
        item(7, "Total", raw_value="9", value_text="9"),
    ]})
    flat = ex.flatten_values(rows, strict=True)
    assert tuples(flat, "field_key", "value") == [("Total", "9"), ("Vendor", "ACME")]


def test_pending_with_empty_text_stays(results):
    rows = results({1: [item(5, "a", raw_value="", is_processing=True)]})
    assert ex.drop_pending(rows).count() == 1


def test_documents_without_items_stay(results, table):
    rows = results({1: [item(5, "Total", 1.0)]})
    flat = ex.flatten_values(rows, documents=table("id long", (1,), (2,)))
    assert tuples(flat, "document_id", "field_key") == [(1, "Total"), (2, None)]


def test_last_item_of_a_prompt_wins(results):
    rows = results({1: [item(5, "Total", "old"), item(6, "x", "y"), item(5, "Total", "new")]})
    got = tuples(ex.with_value_type(ex.last_per_prompt(rows)), "prompt_id", "value")
    assert got == [(5, "new"), (6, "y")]


def test_placeholders_for_running_documents(results, table):
    rows = results({1: [item(5, "Total", "1")], 2: []})
    docs = table("id long, has_active_workflow boolean", (1, True), (2, True), (3, False))
    got = ex.with_pending_placeholders(docs, rows, [5, 6])
    assert tuples(got, "document_id", "prompt_id", "is_processing") == sorted(
        [(1, 5, None), (1, 6, True), (2, 5, True), (2, 6, True)], key=repr)
    assert ex.drop_pending(got).count() == 1


def test_no_prompts_means_no_join(results, table):
    docs = table("id long, name string", (1, "a"))
    rows = results({1: [item(5, "Total", "1")]})
    assert ex.attach_results(docs, rows, None).columns == ["id", "name"]
    assert ex.nest_results(docs, rows, []).columns == ["id", "name"]
    nested = ex.nest_results(docs, rows, [5]).first()["extraction_results"]
    assert [i["prompt_id"] for i in nested] == [5]


def test_traceback_of_item_without_any(results):
    rows = results({1: [item(5, "a", "x"), item(6, "b", "y", traceback=[
        {"bbox": {"top": 1.0, "left": 2.0, "width": 3.0, "height": 4.0}, "page": 1, "confidence": 0.5,
         "issues": ["blurred", "cut"]}])]})
    got = tuples(ex.traceback_rows(rows), "prompt_id", "item_no", "page", "top")
    assert (6, 0, 1, 1.0) in got and any(r[0] == 5 and r[2] is None for r in got)
    assert tuples(ex.traceback_issues(rows), "prompt_id", "issue") == [(6, "blurred"), (6, "cut")]


CASES = [
    ("Number", "$1,234.50", "number", "1234.5"), ("Number", "1/8", None, None),
    ("Number", "-.5", "number", "-0.5"), ("Number", "1e5", None, None),
    ("Date", "02/29/2024", "date", "2024-02-29"), ("Date", "2024-02-29", "date", "2024-02-29"),
    ("Date", "02/30/2024", None, None), ("Date", "Not Found", None, None),
    ("Boolean", "No", "bool", "false"), ("Boolean", "YES", "bool", "true"), ("Boolean", "maybe", None, None),
    ("String", "", "text", ""), ("Weird", "x", None, None), ("Number", None, None, None),
]


def test_typing_raw_text(table):
    raw = table("data_type string, raw_value string", *[(c[0], c[1]) for c in CASES])
    got = ex.with_value_type(ex.type_raw_values(raw))
    assert tuples(got, "data_type", "raw_value", "value_type", "value") == sorted(CASES, key=repr)


@pytest.mark.parametrize(
    ("raw", "overflow"),
    [("123456789012345", False), ("1234567890123456", True), ("0." + "1" * 23, False),
     ("0." + "1" * 24, True), ("0.5" + "0" * 30, False), ("abc", False), ("9" * 60, True)],
)
def test_numbers_are_flagged_not_rounded(table, raw, overflow):
    got = ex.type_raw_values(table("data_type string, raw_value string", ("Number", raw))).first()
    assert got["number_overflow"] is overflow
    assert (got["value_number"] is None) is (overflow or raw == "abc")
    if got["value_number"] is not None:
        assert got["value_number"] == Decimal(raw)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(min_value=-(10**14), max_value=10**14, places=6), min_size=1, max_size=30))
def test_exact_numbers_survive(table, numbers):
    rows = [("Number", f"{n:f}") for n in numbers]
    typed = ex.type_raw_values(table("data_type string, raw_value string", *rows))
    assert sorted(r["value_number"] for r in typed.collect()) == sorted(numbers)


def test_extractor_covers_the_whole_text(table):
    far = "- " * 300_000 + "a@b.cc"
    docs = table("id long, text string", (1, far), (2, "none"), (3, None))
    rules = [ex.ExtractRule(1, "email", "String", r"[a-z]+@[a-z.]+[a-z]")]
    assert tuples(ex.run_extractor(docs, rules), "document_id", "raw_value") == [(1, "a@b.cc")]
    kept = ex.run_extractor(docs, rules, keep_unanswered=True)
    assert tuples(kept, "document_id", "raw_value") == sorted([(1, "a@b.cc"), (2, None), (3, None)], key=repr)


def test_user_extractor_and_classifier(table):
    docs = table("id long, text string", (1, "aa"), (2, "b"))
    found = ex.run_user_extractor(docs, {
        4: ("length", "Number", lambda texts: [str(len(t)) for t in texts]),
        5: (None, "String", lambda texts: [t if t == "b" else None for t in texts])})
    assert tuples(found, "document_id", "prompt_id", "raw_value") == [(1, 4, "2"), (2, 4, "1"), (2, 5, "b")]

    def classify(texts):
        return pd.DataFrame({"document_class": texts.str[0], "document_subclass": None})

    assert tuples(ex.run_user_classifier(docs, classify), "id", "document_class") == [(1, "a"), (2, "b")]


def test_classifier_ties_and_misses(table):
    docs = table("id long, text string", (1, "cat dog"), (2, "dog dog"), (3, "fish"), (4, None))
    rules = [ex.ClassRule("c", "cat"), ex.ClassRule("d", "dog", 1, "big")]
    got = ex.run_classifier(docs, rules)
    assert tuples(got, "id", "document_class", "document_subclass") == sorted(
        [(1, "c", None), (2, "d", "big"), (3, None, None), (4, None, None)], key=repr)


def test_splitter_ids_are_stable_and_checked(table):
    docs = table("id long, text string", (7, "a--b-- --c"))
    got = ex.run_splitter(docs, "--", first_id=100, stride=10)
    assert tuples(got, "id", "source_document", "text") == [(170, 7, "a"), (171, 7, "b"), (173, 7, "c")]
    with pytest.raises(Exception, match="too many splits"):
        ex.run_splitter(docs, "--", first_id=100, stride=2).collect()


def test_splitter_takes_texts_of_any_size(table):
    docs = table("id long, text string", (7, "a--b"), (8, "--".join("x" * 50)))
    first = ex.run_splitter(docs, "--", first_id=100)
    assert first.count() == 52 and first.select("id").distinct().count() == 52
    again = ex.run_splitter(first.drop("source_document", "position"), "x", first_id=first.agg({"id": "max"}).first()[0] + 1)
    assert again.select("id").distinct().count() == again.count()


def test_empty_answer_is_an_answer(table):
    docs = table("id long, text string", (1, "total=;"), (2, "total=5"), (3, "none"))
    rule = ex.ExtractRule(1, "Total", "String", "total=([0-9]*)", 1)
    assert tuples(ex.run_extractor(docs, [rule]), "document_id", "raw_value") == [(1, ""), (2, "5")]


@pytest.mark.parametrize(("pattern", "literal", "any_case", "never_empty"), [
    (r"[+]1 [(][0-9]{3}[)] [0-9]{3}-[0-9]{4}", "+1 (", False, True),
    (r"total=([0-9]*)", "total=", False, True),
    (r"(?i)Total[ ]?due", "Total", True, True),
    (r"(?:foo|bar)baz+q?", "baz", False, True),
    (r"foot|food", "foo", False, True),
    (r"\bab(cd)ef\b", "abcdef", False, True),
    (r"x*", None, False, False),
    (r"(?:abc)*", None, False, False),
    (r"[0-9]{16}", None, False, True),
    (r"naïve word", "ve word", False, True),
])
def test_needed_literals(pattern, literal, any_case, never_empty):
    need = need_of(pattern)
    assert (need.literal, need.any_case, need.never_empty) == (literal, any_case, never_empty)


@pytest.mark.parametrize("pattern", [r"[a-z&&[^bc]]xyz", r"\Qa.b\E", r"(?<n>abc)", r"\hword", r"(?x)a b c", r"a(?s:b.c)\p{L}"])
def test_patterns_that_only_java_reads_are_not_guessed(pattern):
    assert need_of(pattern).literal is None


@pytest.mark.parametrize("many", [1, 1000])
def test_literal_filter_changes_no_answer(table, monkeypatch, many):
    monkeypatch.setattr(patterns, "MANY", many)
    texts = ["Total=5 total=7", "TOTAL DUE 3", "abc abcd", "", None, "x&y ünï total=", "\u212aelvin kelvin", "foo.bar", "zzz" * 5000 + "end total=9"]
    docs = table("id long, text string, __may string", *[(i, x, "mine") for i, x in enumerate(texts)])
    rules = [r"total=([0-9]*)", r"(?i)total due", r"abcd?", r"kelvin", r"(?i)kelvin", r"x*", r"foo[.]bar|bar", r"[a-z&&[^z]]+ total", r"end (?:total)=9"]
    found = ex.run_extractor(docs.drop("__may"), [ex.ExtractRule(n, f"r{n}", "String", p, 1 if "(" in p and "?" not in p else 0) for n, p in enumerate(rules)])
    got = {(r["document_id"], r["prompt_id"]): r["raw_value"] for r in found.collect()}
    plain = docs.where("text is not null")
    for n, p in enumerate(rules):
        group = 1 if "(" in p and "?" not in p else 0
        for r in plain.select("id", F.col("text").rlike(p).alias("hit"), F.regexp_extract("text", p, group).alias("value")).collect():
            assert got.get((r["id"], n)) == (r["value"] if r["hit"] else None)
    classes = [ex.ClassRule(f"c{n}", p) for n, p in enumerate(rules) if p != "x*"]
    labels = {r["id"]: r["document_class"] for r in ex.run_classifier(docs.drop("__may"), classes, spread=3).collect()}
    for i, x in enumerate(texts):
        hits = [r["n"] for n, p in enumerate(rules) if p != "x*" for r in docs.where((F.col("id") == i) & F.col("text").rlike(p)).select(F.lit(n).alias("n")).collect()]
        assert labels[i] == (f"c{hits[0]}" if hits else None)


def test_flatten_reads_its_input_once(spark, table):
    """The check is part of the same plan: one scan of the results, and none beside it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = table("id long, text string", *[(i, f"total={i}") for i in range(50)])
    rule = ex.ExtractRule(1, "Total", "Number", "total=([0-9]*)", 1)
    found = ex.run_extractor(docs, [rule])
    counted = found.mapInArrow(count, found.schema)
    assert ex.flatten_values(counted).count() == 50 and seen.value == 50
    assert "Window" not in ex.flatten_values(found, rules=[rule])._jdf.queryExecution().toString()
    assert not ex.distinct_keys([rule, ex.ExtractRule(2, "Total", "Number", "x")])


def test_collisions_in_a_cell_raise(table):
    schema = "document_id long, key_kind string, field_key string, value string"
    flat = table(schema, (1, "name", "T", "a"), (1, "name", "T", "b"), (2, "name", "T", "c"))
    with pytest.raises(Exception, match="more than once on document 1"):
        ex.pivot_values(flat, ["T"]).collect()
    assert tuples(ex.pivot_values(flat.where("document_id = 2"), ["T"])) == [(2, "c")]


def test_placeholders_of_the_given_documents_only(table):
    docs = table("id long, has_active_workflow boolean", (1, True))
    found = table("document_id long, prompt_id long, raw_value string", (1, 1, "a"), (1, 1, "a"), (2, 1, "b"), (2, 2, "c"))
    rows = ex.with_pending_placeholders(docs, found, [1, 2])
    assert tuples(rows, "document_id", "prompt_id", "raw_value") == sorted([(1, 1, "a"), (1, 1, "a"), (1, 2, None)], key=repr)


def test_wide_csv_has_blanks(results, spark, tmp_path):
    from docloom.sources.export import write_wide_csv

    rows = results({1: [item(5, "b", "x"), item(6, "a", "y")], 2: [item(5, "b", "z")]})
    write_wide_csv(ex.flatten_values(rows, strict=True), str(tmp_path / "out"))
    lines = sorted(line for f in (tmp_path / "out").glob("*.csv") for line in f.read_text().splitlines())
    assert set(lines) == {"document_id,a,b", "1,y,x", "2,,z"}


def test_value_column_name_is_safe(results):
    rows = results({1: [item(5, "odd.name `x`", "v")]})
    from docloom.sources.export import wide_table

    assert wide_table(ex.flatten_values(rows)).first()[1] == "v"
