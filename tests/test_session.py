from __future__ import annotations

from pathlib import Path

import pytest

from sessionvol import session


def test_folders_are_removed_once_nothing_reads_them(spark):
    mark = session.folder_mark()
    kept, gone = session.settle(spark.range(3)), session.settle(spark.range(4))
    made = session.folders_since(mark)
    assert len(made) == 2 and kept.count() == 3
    session.remove_folders(spark, made[1])
    assert session.folders_since(mark) == made[:1]
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        gone.collect()
    assert kept.count() == 3
    with pytest.raises(ValueError, match="folder of this application"):
        session.remove_folders(spark, str(Path(made[0]).parent))
