import pytest
from conftest import rows

from brightloom.operators import names, quality
from brightloom.sources.contracts import load_contract

CONTRACT = {"required_columns": ["province", "year", "rate"],
            "validation": {"province": {"unique_count_min": 2, "unique_count_max": 3}, "rate": {"min": 0, "max": 100}}}


@pytest.mark.parametrize("data, schema, want", [
    ([("a", 2020, 1.0), ("b", 2020, 2.0)], "province string, year int, rate double", []),
    ([("a", 1.0), ("b", 2.0)], "province string, rate double", ["missing column year"]),
    ([("a", 2020, 101.0), ("b", 2020, 2.0)], "province string, year int, rate double", ["rate: above 100"]),
    ([("a", 2020, 1.0)], "province string, year int, rate double", ["province: 1 distinct values, minimum 2"]),
    ([("a", 2020, "x"), ("b", 2020, "5")], "province string, year int, rate string", ["rate: non-numeric values"]),
])
def test_contract(frame, data, schema, want):
    got = quality.contract_violations(frame(data, schema), "d", CONTRACT)
    assert [r["violation"] for r in got.collect()] == want


def test_empty_contract(frame):
    df = frame([], "province string, year int, rate double")
    found = [r["violation"] for r in quality.contract_violations(df, "d", CONTRACT).collect()]
    assert "no rows" in found
    with pytest.raises(quality.QualityError, match="no rows"):
        quality.raise_on(quality.contract_violations(df, "d", CONTRACT), "contract")


def test_contract_file(tmp_path):
    path = tmp_path / "poverty.yml"
    path.write_text("dataset: poverty\nrequired_columns: [province, year]\nvalidation:\n  year:\n    min: 2010\n")
    assert load_contract(str(path)) == {"dataset": "poverty", "required_columns": ["province", "year"], "validation": {"year": {"min": 2010}}}


def test_merged_table(frame):
    df = frame([("a", 120.0), ("a", 5.0), ("b", None)], "province string, rate double")
    got = {r[0] for r in quality.merged_table_violations(df, "province", 38, {"rate": (0, 100), "ipm": (0, 100)}).collect()}
    assert got == {"duplicate province", "expected 38 rows, got 3", "missing column ipm", "rate: outside 0 to 100"}


def test_profiles(frame):
    df = frame([("x", 1.0), (" ", None), (None, float("nan"))], "t string, v double")
    assert rows(quality.missing_profile(df), "column_name") == [("t", 2, 66.67), ("v", 2, 66.67)]
    bad = quality.invalid_categories(frame([("Yes",), ("No",), ("maybe",), (None,)], "p string"), {"p": ["Yes", "No"], "absent": []})
    assert rows(bad) == [("p", "maybe", 1)]
    imp = quality.impossible_values(frame([(-1, 3.0), (130, 4.0)], "tenure int, charge double"), {"tenure": (0, 120), "charge": (0, None)})
    assert dict((r["column_name"], r["verdict"]) for r in imp.collect()) == {"tenure": "below minimum", "charge": "ok"}


def test_iqr(frame):
    df = frame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "v double")
    r = quality.iqr_outliers(df, "v").first()
    assert (r["outliers"], r["low"], r["high"]) == (1, -1.5, 8.5)


def test_names(frame):
    variants = names.variant_map(names.build_variants(
        frame([(11, " ACEH "), (51, "bali"), (21, "kep. riau"), (9999, "INDONESIA")], "code int, name string"), "code", "name",
        frame([("Bali", "Pulau Bali")], "canonical_name string, variant string")), "code")
    assert dict(rows(variants)) == {"aceh": "Aceh", "bali": "Bali", "pulau bali": "Bali", "kep. riau": "Kep. Riau", "kepriau": "Kep. Riau"}
    raw = frame([("ACEH", 2020, 1.0), (" bali ", 2020, 2.0), ("BALI", 2020, 2.0), ("Bali", 2020, 3.0), ("INDONESIA", 2020, 9.0)],
                "province string, year int, rate double")
    clean = names.standardize(raw, "province", variants)
    assert {r["province"] for r in clean.collect()} == {"Aceh", "Bali"}
    assert names.cleaning_report(raw, "province", variants, ["province", "year"], ["rate"]).first().asDict() == {
        "rows_in": 5, "rows_not_entity": 1, "rows_repeated": 1, "rows_out": 3}
    conflicts = quality.conflicting_keys(clean, ["province", "year"], ["rate"])
    assert rows(conflicts.select("province", "variants")) == [("Bali", 2)]
    with pytest.raises(Exception, match="unknown name"):
        names.standardize_strict(raw, "province", variants).collect()


def test_join_sides(frame):
    left, right = frame([("a",), ("b",)], "k string"), frame([("b",), ("c",)], "k string")
    assert rows(quality.join_sides(left, right, "k"), "k") == [("a", "left_only"), ("b", "both"), ("c", "right_only")]
    with pytest.raises(quality.QualityError):
        quality.require_both_sides(left, right, "k")
