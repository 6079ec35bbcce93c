"""Pipelines on hand-made feeds."""

import datetime as dt


from citylake.operators.graph import build_graph
from citylake.plans import accommodation as A
from citylake.plans import cultural as C
from citylake.plans import events as E
from citylake.plans import postal_graph as P
from citylake.plans import weather as W

SHARED = [
    "id", "name", "description", "address", "email", "website", "city", "start_date", "end_date", "Point",
    "SPORT", "NATURE", "CULTURE", "SOCIAL_LIFE",
]


def frame(spark, **columns):
    names = list(columns)
    types = ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(list(zip(*columns.values())), types)


def test_rome(spark):
    raw = frame(
        spark,
        **{
            "_id": ["1", "2", "3"],
            "id_": ["10", "11", "12"],
            "Denominazione": ["Museo", "Museo", "Bar"],
            "Descrizione": ["aperto dal 1/2/25", "x", "/"],
            "Indirizzo": [" Via  Roma ,1", "y", "z"],
            "Mail": ["a@b.it; no", None, "/"],
            "Sito web": ["/", "w", "w"],
            "Zona Wi-Fi": ["SI", "no", "si"],
            "Latitudine": ["41.9", "41.9", "n/a"],
            "Longitudine": ["12.5", "12.5", "12.5"],
            "city": ["Rome", "Rome", "Rome"],
        },
    )
    words = spark.createDataFrame([("Museo", "Museum")], "source string, target string")
    out = E.rome_events(E.rome_trusted(raw), words)
    assert out.columns == SHARED
    (row,) = out.collect()
    assert row.id == "10" and row.name == "Museum" and row.CULTURE == 1
    assert row.description == "aperto dal 1 February 2025."
    assert row.address == "via roma, 1" and row.email is None and row.website is None
    assert row.Point == "POINT(12.5 41.9)" and row.start_date == dt.date(2025, 1, 1)


def test_paris(spark):
    raw = frame(
        spark,
        **{
            "ID": ["1", "1", "x", "y"],
            "Titre": ["<b>l&#39;art</b>"] * 4,
            "Description": ["<p>à  voir !!</p>"] * 4,
            "Adresse du lieu": ["1 Rue X"] * 4,
            "Ville": ["Paris"] * 4,
            "Code postal": ["75001"] * 4,
            "URL": ["https://a.example.com", "bad", "bad", "bad"],
            "Coordonnées géographiques": ["48.8, 2.3", "48.8, 2.3", "48.8, 2.3", None],
            "Date de début": ["2025-06-05 09:00:00"] * 4,
            "Date de fin": ["2025-06-05T09:00:00"] * 4,
        },
    )
    trusted = E.paris_trusted(raw)
    assert trusted.count() == 2  # one per id, unreadable ids share the null key
    assert E.paris_trusted(raw, null_keys="keep").count() == 3
    out = E.paris_events(trusted)
    assert out.columns == SHARED
    row = out.where("id = 1").first()
    assert row.name == "L'art" and row.description == "À voir! !" and row.city == "paris"
    assert row.start_date == dt.datetime(2025, 6, 5, 9) and row.end_date is None and row.email == "not avl"


def test_barcelona(spark):
    raw = frame(
        spark,
        register_id=["7", "7"],
        name=["qué tal?", "vieja"],
        created=["2025-02-01 00:00:00", "2025-01-01 00:00:00"],
        modified=["nan", "nan"],
        addresses_zip_code=["08001", "08001"],
        addresses_town=["Barcelona", "Barcelona"],
        addresses_main_address=["C/ X", "C/ X"],
        values_description=[" Concert ", None],
        geo_epgs_4326_lat=["nan", "nan"],
        geo_epgs_4326_lon=["2.1", "2.1"],
        start_date=["2025-03-01 10:00:00", None],
        end_date=[None, None],
        city=["Barcelona", "Barcelona"],
    )
    out = E.barcelona_events(E.barcelona_trusted(raw))
    (row,) = out.collect()
    assert row.id == 7 and row.name == "¿Qué tal?" and row.description == "concert" and row.CULTURE == 1
    assert row.Point == "POINT(2.1 nan)" and row.email == "not avl"
    assert E.barcelona_events(E.barcelona_trusted(raw), only_positioned=True).isEmpty()


def test_madrid(spark):
    raw = frame(
        spark,
        **{
            "ID-EVENTO": ["1", "1"],
            "TITULO": ["hola!", "hola!"],
            "DESCRIPCION": ["En el PARK", "En el PARK"],
            "DIAS-SEMANA": ["l;m", "l;m"],
            "CODIGO-POSTAL-INSTALACION": ["28001", "28001"],
            "LATITUD": ["40.4", "40.4"],
            "LONGITUD": ["-3.7", "-3.7"],
            "NOMBRE-VIA-INSTALACION": [" MAYOR ", " MAYOR "],
            "CONTENT-URL": ["http://www.madrid.es/x", "http://www.madrid.es/x"],
            "FECHA": ["2025-06-05 00:00:00.0", "2025-06-05 00:00:00.0"],
            "FECHA-FIN": ["2025-06-06 00:00:00.0", "2025-06-06 00:00:00.0"],
            " city": ["Madrid", "Madrid"],
        },
    )
    (row,) = E.madrid_events(E.madrid_trusted(raw)).collect()
    assert row.name == "¡Hola!" and row.address == "mayor" and row.NATURE == 1 and row.city == "madrid"
    assert row.Point == "POINT(-3.7 40.4)" and row.website == "http://www.madrid.es/x"
    tables = E.exploitation_tables({"madrid": raw})
    assert list(tables) == ["madrid_expl"] and tables["madrid_expl"].columns == SHARED


def test_cultural_places(spark):
    madrid = frame(
        spark,
        **{
            "PK": ["1", "2"], "NOMBRE": ["Teátro  A-B.", "x"], "CODIGO-POSTAL": ["8001", "no"],
            "NOMBRE-VIA": ["Mayor", "y"], "COORDENADA-X": ["440123.5", "1"], "COORDENADA-Y": ["2.5", "1"],
        },
    )
    paris = frame(
        spark, identifiant=["p"], nom_officiel=["Louvre"], code_postal=["75001"], adresse=["Rue"],
        coordonnees=["48.8, 2.3"],
    )
    barcelona = frame(
        spark, _id=["b"], name=["n"], addresses_zip_code=[None], addresses_road_name=["r"],
        geo_epgs_25831_x=["1"], geo_epgs_25831_y=["1"],
    )
    out = C.cultural_places(barcelona, [madrid], paris)
    assert out.columns == C.COLUMNS
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1", "teatro ab", "08001", "mayor", 440124, 2, "Madrid"),
        ("p", "louvre", "75001", "rue", 488000000, 23000000, "Paris"),
    ]


def test_record_pages(spark):
    by_result = spark.createDataFrame([(([(1,), (2,)],),)], "result struct<records:array<struct<a:int>>>")
    by_data = spark.createDataFrame([([(3,)],)], "data array<struct<a:int>>")
    tables = C.records_table({"x": by_result, "y": by_data})
    assert [r.a for r in tables["x"].orderBy("a").collect()] == [1, 2]
    assert [r.a for r in tables["y"].collect()] == [3]


def test_accommodation(spark, tmp_path):
    (tmp_path / "Rome.json").write_text(
        '{"data": {"hotels": [{"hotel_id": 5, "accessibilityLabel": "l", "property": {"name": "N",'
        ' "photoUrls": ["a"], "latitude": 41.0, "longitude": 12.0, "checkin": {"fromTime": "14:00"},'
        ' "priceBreakdown": {"grossPrice": {"value": 10, "currency": "EUR"},'
        ' "benefitBadges": [{"variant": "v"}]}}}, {"hotel_id": 99999999999}]}}'
    )
    documents = spark.read.schema(A.RAW_SCHEMA).option("multiLine", True).json(str(tmp_path))
    trusted = A.accommodation_trusted(documents)
    assert trusted.schema.simpleString() == A.accommodation_schema().simpleString()
    assert trusted.count() == 2
    places = spark.createDataFrame(
        [("Via 1", "00100", 41.001, 12.0)], "address string, postcode string, latitude double, longitude double"
    )
    out = A.accommodation(trusted, places, "Rome")
    row = out.where("hotel_id = 5").first()
    assert row.property_address == "Via 1" and row.property_postalcode == "00100"
    assert row.property_priceBreakdown_grossPrice_value == 10.0 and row.city_code_name == "Rome"
    assert row.property_photoHash == ["ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"]
    assert A.BADGES not in out.columns
    other = out.where("hotel_id IS NULL").first()
    assert other.property_photoHash == [] and other.property_address is None


def test_weather(spark):
    raw = spark.createDataFrame(
        [((["2024-07-05T00:00", "2024-07-05T01:00"], [1.5, 2.5], [10]),)],
        "hourly struct<time:array<string>,rain:array<double>,cloud_cover:array<bigint>>",
    )
    trusted = W.weather_trusted(raw)
    assert trusted.schema.simpleString() == W.weather_schema().simpleString()
    (row,) = W.weather(trusted, "Rome").collect()
    assert (row.timestamp, row.time, row.rain, row.cloud_cover) == ("2024-07-05T00:00", "00:00", 1.5, 10)


def test_postal_graph_is_rebuilt(spark, tmp_path):
    ring = lambda x: [(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)]
    shape = "COD_POSTAL string, ring array<struct<x:double,y:double>>"
    polygons = spark.createDataFrame([("28001", ring(0.0)), ("28002", ring(1.0)), ("08001", ring(2.0))], shape)
    madrid = P.spanish_cities(polygons, ["Madrid"])
    hotels = spark.createDataFrame(
        [(1, 1.0, 2.0, "H", "Madrid", "28001"), (1, 1.0, 2.0, "H", "Madrid", "28001")],
        "property_id int, property_latitude double, property_longitude double, property_name string,"
        "city_code_name string, property_postalcode string",
    )
    graph = P.postal_graph({"Madrid": madrid}, hotels)
    for _ in range(2):
        build_graph(graph, str(tmp_path))
    read = lambda n: spark.read.parquet(f"{tmp_path}/{n}")
    assert read("zip_nodes").count() == 2 and read("accommodation_nodes").count() == 1
    assert {(r.SRC, r.DST, r.Distance) for r in read("route_edges").collect()} == {
        ("28001", "28002", 1.0), ("28002", "28001", 1.0),
    }
    assert [(r.ID, r.ZIPCODE) for r in read("located_in_edges").collect()] == [("1", "28001")]


def test_paris_polygons(spark):
    df = spark.createDataFrame([("75001", "Lyon"), ("75002", "Paris"), ("69001", None)], "ID string, LIB string")
    used = spark.createDataFrame([("75001",)], "property_postalcode string")
    assert {r.ID for r in P.paris_polygons(df, used).collect()} == {"75001", "75002"}


def test_filtered_events(spark):
    df = spark.createDataFrame([(1, 1), (2, 0)], "id int, SOCIAL_LIFE int")
    assert [r.id for r in E.filtered_events(df).collect()] == [1]
    assert E.filtered_events(df, "").count() == 2
