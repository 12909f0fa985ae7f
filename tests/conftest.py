import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

from quire.model import table  # noqa: E402
from quire.operators.clean import pad_fixed  # noqa: E402
from quire.session import build_session  # noqa: E402
from quire.sources import read_delimited  # noqa: E402
from tests.sample_rows import MISSING_IN_BRONZE, SAMPLE  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "quire-tests",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def landing(tmp_path_factory):
    """The sample rows as pipe-delimited files."""
    folder = tmp_path_factory.mktemp("landing")
    for name, text in SAMPLE.items():
        (folder / f"{name}.csv").write_text(text.strip() + "\n", encoding="utf-8")
    return folder


@pytest.fixture(scope="session")
def sources(spark, landing):
    """The sample tables as a fixed-width source delivers them; nine books as in the raw layer."""
    frames = {
        name: pad_fixed(read_delimited(spark, str(landing / f"{name}.csv"), table(name).schema), table(name))
        for name in SAMPLE
    }
    frames["ouvrages"] = frames["ouvrages"].filter(f"OVISBN <> '{MISSING_IN_BRONZE}'")
    return frames


@pytest.fixture(scope="session")
def small_folder():
    if not Path(SMALL).is_dir():
        pytest.skip("no test tables here")
    return SMALL
