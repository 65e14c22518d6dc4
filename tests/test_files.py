"""CSV in and out."""

import os

import pytest
from conftest import rows

from clickloom import schemas
from clickloom.plans import country
from clickloom.sources import files, tables


def write(tmp_path, text, name="in.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_read_drops_the_header(spark, tmp_path):
    path = write(tmp_path, 'country,capital\nKorea,Seoul\nPeru,\n"A, B",C\n')
    assert rows(files.read_country_csv(spark, path)) == [("A, B", "C"), ("Korea", "Seoul"), ("Peru", None)]
    assert files.read_country_csv(spark, write(tmp_path, "country,capital\n", "empty.csv")).count() == 0


@pytest.mark.parametrize("line", ["alone", "a,b,c"])
def test_wrong_field_count_raises(spark, tmp_path, line):
    path = write(tmp_path, f"country,capital\nKorea,Seoul\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_country_csv(spark, path).collect()


def test_country_load(spark, db, tmp_path):
    path = write(tmp_path, "country,capital\nKorea,Seoul\nPeru,Lima\n")
    for _ in range(2):
        country.load(spark, path, str(tmp_path / "landing"), db)
    assert rows(spark.table(f"{db}.country_capital")) == [("Korea", "Seoul"), ("Peru", "Lima")]


def test_country_is_required(spark, db, tmp_path):
    country.load(spark, write(tmp_path, "country,capital\nKorea,Seoul\n"), str(tmp_path / "landing"), db)
    bad = write(tmp_path, "country,capital\n,Lima\n", "bad.csv")
    with pytest.raises(ValueError, match="country"):
        country.load(spark, bad, str(tmp_path / "landing2"), db)
    assert rows(spark.table(f"{db}.country_capital")) == [("Korea", "Seoul")]


def test_refresh_is_idempotent_and_rolls_back(spark, db, tmp_path):
    lines = "".join(f"c{i:03d},x{i}\n" for i in range(248))
    path = write(tmp_path, "country,capital\n" + lines)
    for _ in range(2):
        stats = country.refresh(spark, path, db)
        assert [tuple(r) for r in stats.collect()] == [(f"c{i:03d}", f"x{i}", 248) for i in range(5)]
    with pytest.raises(Exception, match="(?i)malformed"):
        country.refresh(spark, write(tmp_path, "country,capital\nA,B\nbroken\n", "bad.csv"), db)
    assert spark.table(f"{db}.country_capital").count() == 248


def test_export_round_trip(spark, tmp_path):
    data = [("u,1", 'say "hi"', "view", 12_500_000.0, 5), ("ü", "", "cart", 0.1, 4), ("u3", "i3", "like", 1e-7, 3)]
    df = spark.createDataFrame(data, schemas.EXPORTS["interaction"])
    path = files.export_csv(df, str(tmp_path), "interaction/interaction_train_data", "2024-01-15", single_file=True)
    assert path.endswith("interaction/interaction_train_data_2024-01-15.csv")
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(parts) == 1
    text = open(os.path.join(path, parts[0]), encoding="utf-8").read()
    assert text.startswith("user_id,item_id,event_type,event_value,timestamp\n")
    assert "12500000.0" in text and '"say ""hi"""' in text
    back = rows(files.read_export(spark, str(tmp_path), "interaction", "2024-01-15"))
    # An empty text cannot be told from a missing one in a CSV.
    assert back == rows(df.replace({"": None}, subset=["item_id"]))


def test_export_check(spark, tmp_path):
    good = spark.createDataFrame([("a", 1)], schemas.USER_TRAIN)
    files.export_csv(good, str(tmp_path), "user/user_train_data", "2024-01-15")
    assert files.check_export(spark, str(tmp_path), "user", "2024-01-15") == 1
    bad = spark.createDataFrame([("a", None)], schemas.USER_TRAIN)
    with pytest.raises(ValueError, match="created_at"):
        files.export_csv(bad, str(tmp_path), "user/user_train_data", "2024-01-16", required=bad.columns)
    odd = spark.createDataFrame([("", 1), ('two\nlines "quoted", and a comma', 2)], schemas.USER_TRAIN)
    files.export_csv(odd, str(tmp_path), "user/user_train_data", "2024-01-18", required=odd.columns)
    assert files.check_export(spark, str(tmp_path), "user", "2024-01-18") == 2
    files.export_csv(good.where("1 = 0"), str(tmp_path), "user/user_train_data", "2024-01-17")
    with pytest.raises(Exception):
        files.check_export(spark, str(tmp_path), "user", "2024-01-17")


def test_load_csv_replaces(spark, db, tmp_path):
    name = f"{db}.c"
    for text in ("country,capital\nA,B\nC,D\n", "country,capital\nE,F\n"):
        files.load_csv(spark, write(tmp_path, text), name, schemas.COUNTRY_CAPITAL, ["country"])
    assert rows(spark.table(name)) == [("E", "F")]
    tables.append(spark, name, spark.table(name).limit(0))
    assert spark.table(name).count() == 1
