import os
import tempfile

from pyspark.sql import types as T

from tramline.sources.ledger import Ledger
from tramline.streaming.incremental import clean_new_files

SCHEMA = T.StructType([T.StructField("linie", T.IntegerType()), T.StructField("betriebsdatum", T.StringType()),
                       T.StructField("fw_kurz", T.StringType())])


def _file(d, name, body):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("linie,betriebsdatum,fw_kurz\n" + body)


def test_only_new_files_are_processed(spark):
    tmp = tempfile.mkdtemp(prefix="tramline-stream-")
    src, out, led = f"{tmp}/src", f"{tmp}/out", f"{tmp}/ledger"
    _file(src, "Fahrzeiten_SOLL_IST_20220102_20220108.csv", "2,03.01.22,None\n3,31.02.22,x\n")
    kw = dict(schema=SCHEMA, out_path=out, ledger_path=led, process="Fahrzeiten_Cleaning",
              date_cols=["betriebsdatum"], checkpoint=f"{tmp}/ckpt")
    clean_new_files(spark, src, **kw)
    first = spark.read.parquet(out)
    assert first.count() == 2
    assert first.where("fw_kurz IS NULL").count() == 1          # 'None' unified
    assert first.where("betriebsdatum IS NULL").count() == 1    # 31.02 is no date
    _file(src, "Fahrzeiten_SOLL_IST_20220109_20220115.csv", "4,10.01.22,y\n")
    clean_new_files(spark, src, **kw)
    assert spark.read.parquet(out).count() == 3                 # the old file is not read again
    outputs = sorted(r.output for r in Ledger(spark, led).rows().collect())
    assert outputs == ["Rows: 1; False Dates: 0", "Rows: 2; False Dates: 1"]
