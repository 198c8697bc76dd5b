import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loopcount.schemas import SLOT_NAMES, VOLUME_KEY_HEADER  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[*]")
               .appName("loopcount-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # A checkpoint folder only where the environment names none.
    if not (session.sparkContext.getConf().get("spark.checkpoint.dir", None) or session.sparkContext.getCheckpointDir()):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loopcount-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def quoted(values):
    return ",".join(v if v.startswith('"') or v == "" else f'"{v}"' for v in values)


def write_volume_csv(folder, rows, name="part-00000.csv"):
    """rows: (site, interval, detector, list of 96 field texts, already quoted or bare)."""
    os.makedirs(folder, exist_ok=True)
    header = ",".join(f'"{h}"' for h in VOLUME_KEY_HEADER + SLOT_NAMES)
    lines = [header]
    for site, interval, detector, fields in rows:
        assert len(fields) == 96
        lines.append(",".join([f'"{site}"', f'"{interval}"', f'"{detector}"'] + list(fields)))
    with open(os.path.join(folder, name), "w") as f:
        f.write("\r\n".join(lines) + "\r\n")
    return folder


def write_text(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder
