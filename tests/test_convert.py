import decimal

from pyspark.sql import functions as F

from eventfares.functions.convert import Field, columns


def test_each_kind_and_its_default(spark):
    record = spark.sql(
        """SELECT named_struct('s', 5, 'b', 1, 'z', 0, 'i', '12', 'bad', '12x', 'd', '0.10',
                               't', '9:05:03', 'late', '24:00:00', 'missing', cast(null as int)) AS r"""
    )
    model = (
        Field("text", "string", path="r__s"),
        Field("yes", "boolean", path="r__b"),
        Field("no", "boolean", path="r__z"),
        Field("number", "int", path="r__i"),
        Field("no_number", "int", path="r__bad"),
        Field("no_number_but", "int", path="r__bad", default=-1),
        Field("amount", "decimal", path="r__d"),
        Field("time", "time", path="r__t"),
        Field("no_time", "time", path="r__late"),
        Field("absent", path="r__missing"),
        Field("absent_but", path="r__missing", default=7),
    )
    assert record.select(*columns(model)).first().asDict() == {
        "text": "5",
        "yes": True,
        "no": False,
        "number": 12,
        "no_number": None,
        "no_number_but": -1,
        "amount": decimal.Decimal("0.1"),
        "time": "9:05:03",
        "no_time": None,
        "absent": None,
        "absent_but": 7,
    }


def test_a_path_through_a_missing_object_is_null(spark):
    table = spark.sql("SELECT cast(null AS struct<b: struct<c: int>>) AS a, array(1) AS l")
    model = (Field("c", path="a__b__c"), Field("l", "list"), Field("o", "object", path="a", model=(Field("b"),)))
    assert tuple(table.select(*columns(model)).first()) == (None, [1], None)


def test_dates_and_instants(spark):
    texts = [("2018-11-16", "2018-11-16T20:30:00+0100"), ("16/11/2018", "soon")]
    table = spark.createDataFrame(texts, "d string, i string")
    model = (Field("d", "date"), Field("i", "datetime"))
    rows = table.select(*columns(model)).select("d", F.unix_seconds("i").alias("i")).collect()
    assert [(str(r.d), r.i) for r in rows] == [("2018-11-16", 1542396600), ("None", None)]
