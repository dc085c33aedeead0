SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")
