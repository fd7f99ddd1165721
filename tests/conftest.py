import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[8]", {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def patients(spark):
    """Every third row carries a missing marker; the label follows glucose and bmi."""
    rows = []
    for i in range(400):
        glucose = 0.0 if i % 23 == 0 else 60.0 + (i * 37) % 180
        bmi = 0.0 if i % 29 == 0 else 16.0 + (i * 13) % 40
        insulin = 0.0 if i % 3 == 0 else 20.0 + (i * 7) % 400
        age = 21 + (i * 11) % 70
        noise = (i * 53) % 17
        rows.append(
            (
                f"P{i:04d}",
                (i * 5) % 14,
                glucose,
                50.0 + (i * 3) % 60,
                float((i * 7) % 60),
                insulin,
                bmi,
                0.1 + ((i * 17) % 200) / 100,
                age,
                int(glucose + 2 * bmi + noise > 215),
            )
        )
    return spark.createDataFrame(
        rows,
        "patient_id string, pregnancies int, glucose double, blood_pressure double, skin_thickness double, "
        "insulin double, bmi double, diabetes_pedigree_function double, age int, target int",
    )
