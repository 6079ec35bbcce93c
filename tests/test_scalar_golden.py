"""Golden rows of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from citylake.functions import numeric, postal, temporal, text

ONE_ARG = [
    (text.fix_text, "ciao ,mondo.come va", "Ciao, mondo. Come va"),
    (text.fix_text, "a...b", "A. .. B"),
    (text.fix_text, "  ciao. à  b", "ciao. à b"),
    (text.fix_text, "uno. due", "Uno. Due"),
    (text.fix_text, "", ""),
    (text.fix_text, None, None),
    (text.end_phrase, "fine", "fine."),
    (text.end_phrase, "fine!", "fine!"),
    (text.end_phrase, "fine -", "fine."),
    (text.end_phrase, "caffè", "caffè"),
    (text.end_phrase, "x_ ", "x."),
    (text.end_phrase, "", ""),
    (text.end_phrase, None, None),
    (text.spell_dates, "dal 1/2/25 al 31-02-2024", "dal 1 February 2025 al 31-02-2024"),
    (
        text.spell_dates,
        "dal 1/2/25 al 11/2/2025, 31-02-2024",
        "dal 1 February 2025 al 11 February 2025, 31-02-2024",
    ),
    (text.spell_dates, "1/2/125 1/1/0000 12/13/20", "1 February 125 1 January 2000 12/13/20"),
    (text.spell_dates, "1/2/20245", "1/2/20245"),
    (text.spell_dates, None, None),
    (text.extract_mails, "a@b.it; x , foo-bar@c.it", "a@b.it; bar@c.it"),
    (text.extract_mails, "none here", None),
    (text.extract_mails, "a@b", None),
    (text.slash_to_null, " / ", None),
    (text.slash_to_null, "a/b", "a/b"),
    (text.fix_french, "l&#39;art !!", "L'art! !"),
    (text.fix_french, "à 20:30", "À 20: 30"),
    (text.fix_french, "bon.  été", "Bon. Été"),
    (text.fix_french, None, None),
    (text.fix_spanish, "qué tal?", "¿Qué tal?"),
    (text.fix_spanish, "¡¡hola!", "¡hola!"),
    (text.fix_spanish, "hola. ¿qué tal? éste es. a! b", "Hola. ¿qué tal? Éste es. A! B"),
    (text.html_text, "<p>A<b>b</b>&amp;c</p><script>x</script>", "A b &c"),
    (text.html_text, "A<!-- x > y -->B", "A B"),
    (text.html_text, '<a title="x>y">t</a> 1 < 2', "t  1 < 2"),
    (text.html_text, "<!DOCTYPE html><style>p{}</style>t<script>var a='</p>'", "t"),
    (text.html_text, "&lt;b&gt;&eacute;", "<b>é"),
    (text.html_text, None, None),
    (text.valid_url, "https://a.example.com/x?y=1#z", "https://a.example.com/x?y=1#z"),
    (text.valid_url, "http://localhost:8080", "http://localhost:8080"),
    (text.valid_url, "www.example.com", None),
    (text.valid_url, "http://a b.com", None),
    (text.valid_url, "http://nodot/", None),
    (text.valid_mail, "a.b+c@example.org", "a.b+c@example.org"),
    (text.valid_mail, "a..b@example.org", None),
    (text.valid_mail, "a@b", None),
    (text.valid_mail, "a@site.test", None),
    (text.clean_weekdays, "l;M, x martes,J", "L,M,X,J"),
    (text.clean_weekdays, "lunes", None),
    (text.clean_weekdays, None, None),
    (postal.madrid_postcode, "28081", None),
    (postal.madrid_postcode, "28080", 28080),
    (postal.madrid_postcode, "28080d", None),
    (postal.pad_zip, "801", "00801"),
    (postal.pad_zip, "8001.0", "8001.0"),
    (postal.city_of_postcode, "28001", "Madrid"),
    (postal.city_of_postcode, "08001", "Barcelona"),
    (postal.city_of_postcode, "75001", "Otro"),
    (text.fold_text, "St.  Ána-Mar´", "st anamar´"),
    (text.fold_text, "a    b", "a  b"),
    (text.clean_line, '"A &amp; B&Ntilde;"', "A & Bñ"),
    (text.sha256, "a", "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"),
    (text.sha256, "", None),
    (text.norm, "  A  B ", "a  b"),
    (lambda c: text.norm(c, collapse=True), "  A  B ", "a b"),
    (lambda c: text.map_values(c, {"si": "yes"}), "si", "yes"),
    (lambda c: text.map_values(c, {"si": "yes"}), "no", "no"),
    (temporal.parse_ts, "2025-06-05 09:00:00.0", dt.datetime(2025, 6, 5, 9)),
    (temporal.parse_ts, "2025-06-05T09:00:00+02:00", None),
    (temporal.parse_ts, "2025-13-05 09:00:00", None),
    (temporal.hour_of, "2024-07-05T13:00", "13:00"),
    (temporal.hour_of, "2024-07-05T13:00+02:00", "13:00"),
    (temporal.hour_of, "13:00", None),
    (numeric.round_coord, "2.5", 2),
    (numeric.to_numeric, " 1e3 ", 1000.0),
    (numeric.to_numeric, "nan", None),
    (numeric.to_numeric, "12d", None),
    (numeric.scaled_coords, "48.8, 2.3", (488000000.0, 23000000.0)),
    (numeric.scaled_coords, "48.8,2.3", (488000000.0, 3000000.0)),
    (numeric.scaled_coords, "x, 2", (None, 20000000.0)),
    (numeric.scaled_coords, "123", (120000000.0, 230000000.0)),
    (numeric.split_latlon, "41.5, x", (41.5, None)),
]


def test_one_argument_functions(spark):
    """All golden rows in one job."""
    # Literals fold on the driver; a column keeps the run on the executor path.
    names = [f"i{i}" for i in range(len(ONE_ARG))]
    df = spark.createDataFrame(
        [tuple(g for _, g, _ in ONE_ARG)], ", ".join(f"{n} string" for n in names)
    ).repartition(1)
    row = df.select(*[fn(F.col(n)).alias(n) for n, (fn, _, _) in zip(names, ONE_ARG)]).first()
    wrong = []
    for n, (fn, given, expected) in zip(names, ONE_ARG):
        got = tuple(row[n]) if isinstance(expected, tuple) else row[n]
        if got != expected:
            wrong.append((getattr(fn, "__name__", "?"), given, expected, got))
    assert not wrong


def test_town_postcodes(evaluate):
    rows = [("75001.9", " Paris "), ("75021", "paris"), ("nan", "paris"), ("75001", None)]
    assert evaluate(postal.paris_postcode("c", "t"), "c string, t string", *rows) == [
        75001, None, None, None,
    ]
    assert evaluate(
        postal.barcelona_postcode("c", "t"), "c string, t string", ("08001", "Barcelona")
    ) == [8001]


def test_half_even(evaluate):
    assert evaluate(numeric.round_coord("c"), "c double", 0.5, 1.5, 2.5, float("nan")) == [0, 2, 2, None]


def test_point(evaluate):
    got = evaluate(numeric.point_wkt("x", "y"), "x double, y double", (2.1686, None), (2.1686, 41.0))
    assert got == [None, "POINT(2.1686 41.0)"]


def test_unit_vector(evaluate):
    got = evaluate(numeric.l2_normalise("v"), "v array<double>", ([3.0, 4.0],), ([0.0, 0.0],))
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]
    assert evaluate(numeric.l2_normalise("v", 255), "v array<int>", ([255, 0],)) == [[1.0, 0.0]]


def test_day_shifts(spark):
    row = spark.range(1).select(
        temporal.departure_day(F.lit("2025-07-05").cast("date")).alias("a"),
        temporal.weather_day(F.lit("2025-07-05").cast("date")).alias("b"),
        temporal.same_day_last_year(F.lit("2025-07-05").cast("date")).alias("c"),
    ).first()
    assert tuple(row) == (dt.date(2025, 7, 6), dt.date(2024, 7, 5), dt.date(2024, 7, 5))


def test_decode(evaluate):
    rows = [(bytearray("né".encode()),), (bytearray("né".encode("latin-1")),)]
    assert evaluate(text.decode_text("b"), "b binary", *rows) == ["né", "né"]


def test_hash_array(evaluate):
    (got,) = evaluate(text.hash_array("a"), "a array<string>", (["a"],))
    assert got == ["ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"]


def test_long_markup_does_not_overflow(evaluate):
    page = "<b>" * 200_000 + "x" + "</b>" * 200_000 + "<p " + "a='1' " * 50_000 + ">y" + "\n" * 100_000 + "z"
    (got,) = evaluate(F.regexp_replace(text.html_text("c"), r"\s+", " "), "c string", page)
    assert got == "x y z"
    (got,) = evaluate(text.fix_text("c"), "c string", "a" + " " * 200_000 + "b. c" * 50_000)
    assert got.startswith("A b. C")
