"""What the live job prints itself; the rest comes from the engine's console sink."""

from eventfares.plans import live

from .test_streaming import DATE, Feeds, fare


def test_the_averages_after_each_record_are_printed(spark, tmp_path, capsys):
    folders = Feeds(tmp_path)
    folders.add("concerts", 1, f"1,A,{DATE},Dublin")
    folders.add("fares", 2, *[fare("Dublin", "2018-11-12", 10 + k) for k in range(12)])
    live.main(
        [folders.concerts, folders.fares, folders.work, folders.documents, "--once", "--show", "--delay", "1 hour",
         "--each-record", "--tasks", "3"]
    )
    shown = capsys.readouterr().out
    assert "avg_price" in shown and "Dublin" in shown and "only showing top 10 rows" in shown
