import json

import pytest

from hearthline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "scratch"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def listing(key, timestamp=1763174687104, **fields):
    record = {"timestamp": timestamp, "zpid": key, "city": "Encino", "price": 100}
    return {**record, **fields}


def put_array(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    text = records if isinstance(records, str) else json.dumps(records)
    (folder / name).write_text(text)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
