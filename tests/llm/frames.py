def frame(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)
