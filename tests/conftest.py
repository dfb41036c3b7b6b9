from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from auditlake.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build("tests", "8", memory="4g", partitions=2)
    # Tests run many plans over a handful of rows: compiling them is most of the work.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()
