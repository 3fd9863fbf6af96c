"""python -m sparkloom [PROPERTIES]: the pipeline as its settings say, until SIGTERM or SIGINT."""

from __future__ import annotations

import signal
import sys
import threading

from pyspark.sql import SparkSession

from . import config
from .runner import App


def main(args: list[str]) -> None:
    c = config.load(config.read_properties(args[0]) if args else None)
    spark = SparkSession.builder.appName(c.pipeline_name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    app = App(spark, c)
    server = app.serve()
    for sign in (signal.SIGTERM, signal.SIGINT):
        signal.signal(sign, lambda *_: threading.Thread(target=app.stop).start())
    try:
        app.run()
    finally:
        server.shutdown()
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
