import os

import pytest

from eventfares.llm import warc

from .test_queries import SMALL
from .test_warc import parts


def test_op1_fails_on_an_archive_damaged_between_writing_and_reading(spark, monkeypatch):
    write = warc.write_warc

    def damaged(pages, path, *args):
        write(pages, path, *args)
        part = max(parts(path), key=os.path.getsize)
        with open(part, "r+b") as f:
            f.seek(os.path.getsize(part) // 2)
            f.write(b"\xff" * 40)
        # Hadoop's own check sum of the part would notice first.
        crc = os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc")
        os.path.exists(crc) and os.remove(crc)

    monkeypatch.setattr(warc, "write_warc", damaged)
    for use in (lambda df: df.collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="gap in .* at [0-9]+ of [0-9]+ bytes: "):
            use(warc.op1(spark, SMALL))
