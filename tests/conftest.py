import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    s = local_session(4, memory="4g", **{"spark.sql.warehouse.dir": str(warehouse), "spark.sql.catalogImplementation": "in-memory", "spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return s


@pytest.fixture
def land(tmp_path):
    """Write JSON rows as one NDJSON file under a path of a Bronze root."""

    def write(path, rows, root=tmp_path / "bronze"):
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
        return str(root)

    return write
