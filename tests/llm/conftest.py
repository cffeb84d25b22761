import glob
import os

import duckdb
import pytest

from cloudtally.llm.queries import oracle_sql, queries


@pytest.fixture(scope="session")
def query(spark, sample_dir):
    """Runs a registered query over the sample tables, as pandas."""
    return lambda name: queries()[name](spark, sample_dir).toPandas()


@pytest.fixture(scope="session")
def sample(spark, sample_dir):
    return lambda name: spark.read.parquet(f"{sample_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def oracle(sample_dir):
    def run(name):
        con = duckdb.connect()
        for path in glob.glob(f"{sample_dir}/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
        return con.execute(oracle_sql()[name]).df()
    return run


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that clash with the operators' own."""
    def make(rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None, 7, "x") for r in rows]
        return spark.createDataFrame(
            full, DOCUMENTS + ", score long, component_id string")
    return make
