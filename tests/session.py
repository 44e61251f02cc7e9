"""The local session of tests and benchmarks."""

from citeweave.session import build_session


def local_session(cores=8):
    spark = build_session(
        "citeweave-local",
        f"local[{cores}]",
        **{
            "spark__sql__shuffle__partitions": "8",
            "spark__ui__enabled": "false",
            "spark__driver__memory": "8g",
            "spark__ui__showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
