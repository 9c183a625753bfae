"""Responses whose lists came as single records, inside elements, as nulls, or not at all."""

import json

import pytest

from terraloom.sources import register_responses as R


@pytest.fixture
def landed(spark, tmp_path):
    def land(lines, kind):
        (tmp_path / "x.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
        return R.responses(spark, str(tmp_path / "x.json"), kind)

    return land


def herd(n, **more):
    return {"BesaetningsNummer": n, "BesStr": {"BesaetningsStoerrelseTekst": "Søer", "BesaetningsStoerrelse": n}, **more}


def test_herds_in_every_form(landed):
    forms = [[herd(1), herd(2)], herd(3), {"Besaetning": [herd(4), herd(5)]}, {"Besaetning": herd(6)}, {"Besaetning": None}, {}, None, [], "text"]
    given = landed([{"ChrNummer": i + 1, "Besaetninger": f} for i, f in enumerate(forms)] + [{"ChrNummer": 77}], R.PROPERTY)
    rows = [(r.chr_number, r.herd_number, r["count"]) for r in R.herd_rows(R.herds_of(given)).collect() if r.herd_number]
    assert sorted(rows) == [(1, 1, 1), (1, 2, 2), (2, 3, 3), (3, 4, 4), (3, 5, 5), (4, 6, 6)]
    assert sorted(r.chr_number for r in R.properties(given).collect()) == [*range(1, 10), 77]


def test_a_record_of_another_kind_loses_its_leaf_alone(landed):
    given = landed(["not json", [{"ChrNummer": 1, "Ejendom": {"Adresse": {"odd": 1}, "ByNavn": "By"}}, {"ChrNummer": 2, "Ejendom": "text"}], {"ChrNummer": 3, "Ejendom": {"ByNavn": 5}}], R.PROPERTY)
    assert sorted((r.chr_number, r.property_city) for r in R.properties(given).collect()) == [(1, "By"), (2, None), (3, "5")]


def test_members_events_and_declarations(landed):
    given = landed(
        [
            {"ChrNummer": 1, "SamdriftNaboaftaler": {"Samdrift": {"DyreArtKode": 15, "ChrNumre": {"ChrNummer": 7}}}, "VeterinaereHaendelser": {"VeterinaerHaendelse": {"SygdomsKode": "A"}}},
            {"ChrNummer": 2, "SamdriftNaboaftaler": [{"DyreArtKode": 15, "ChrNumre": [8, 0, 9]}, {"DyreArtKode": 16, "ChrNumre": 10}], "Besaetninger": herd(1, LeveringsErklaeringer={"LeveringsErklaering": {"ChrNummerModtager": 4}})},
        ],
        R.PROPERTY,
    )
    assert sorted(map(tuple, R.agreements(given).collect())) == [(1, 15, 7), (2, 15, 8), (2, 15, 9), (2, 16, 10)]
    assert [(r.chr_number, r.disease_code) for r in R.events(given).collect()] == [(1, "A")]
    assert [r.receiver_chr_number for r in R.declarations(R.herds_of(given)).collect()] == [4]


def test_first_rows_are_whole_and_in_the_order_of_arrival(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for f, lines in (("a.json", [(1, "late"), (1, "later")]), ("0.json", [(1, "first"), (2, "other")])):
        (tmp_path / "d" / f).write_text("\n".join(json.dumps({"ChrNummer": 5, "BesaetningsNummer": 9, "Ejer": {"CvrNummer": c, "Navn": n, "Email": n + "@x"}}) for c, n in lines))
    herds = R.herd_masters(R.responses(spark, str(tmp_path / "d"), R.HERD))
    assert sorted((r.cvr_number, r.name, r.email) for r in R.first_persons(herds, "Ejer", "owner").collect()) == [("1", "first", "first@x"), ("2", "other", "other@x")]


def test_what_a_response_has_once_is_converted_before_its_entries(spark, tmp_path):
    """In all forms of a list, and without a conversion of the period for each entry."""
    entry = {"Aar": 2024, "Maaned": " 5 ", "Dyredage": "12.5", "Dyredoser": "1,5", "Ukendt": {"a": 1}}
    lists = [[entry, entry], entry, [entry, None, 7, {"Aar": {"b": 1}}], [], None]
    (tmp_path / "a.json").write_text("\n".join(json.dumps({"chr_number": i, "period_from": "2024-01-01", "Data": d}) for i, d in enumerate(lists)))
    out = R.antibiotics(R.responses(spark, str(tmp_path), R.ANTIBIOTICS))
    rows = sorted((tuple(r) for r in out.select("chr_number", "year", "month", "animal_days", "animal_doses", "period_from").collect()), key=repr)
    full = lambda i: (i, 2024, 5, None, 1.5, "2024-01-01")
    none = (2, None, None, None, None, "2024-01-01")
    assert rows == sorted([full(0), full(0), full(1), full(2), none, none, none], key=repr)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(") < plan.index("date_format(")
