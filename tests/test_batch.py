import os

from eventfares.plans.batch import average_fares

from .conftest import day


def test_repeats_count_unless_only_the_latest_is_wanted(spark, tmp_path):
    for feed, files in {
        "concerts": {1: "0,A,2018-11-16,Dublin\n", 2: "5,A,2018-11-16,Dublin\nbroken\n"},
        "fares": {1: "P,Dublin,2018-11-12,10\nP,Dublin,2018-11-13,20\n", 2: "P,Dublin,2018-11-12,60.0\n"},
    }.items():
        (tmp_path / feed).mkdir()
        for second, text in files.items():
            path = tmp_path / feed / f"{second}.csv"
            path.write_text(text)
            os.utime(path, (second, second))
    folders = str(tmp_path / "concerts"), str(tmp_path / "fares")
    assert average_fares(spark, *folders).collect() == [("Dublin", day("2018-11-16"), 30.0, 6)]
    latest = average_fares(spark, *folders, latest_only=True)
    assert latest.collect() == [("Dublin", day("2018-11-16"), 40.0, 2)]
