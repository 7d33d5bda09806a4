"""Command line for the streaming bar job (one entry point for every asset class).

    python -m candela.streaming.cli --kafka_servers host:9092 --kafka_topic crypto_data \
        --output_path s3://bucket/crypto --checkpoint_path s3://bucket/ckpt/crypto

``--source_format text --source_path DIR`` reads JSON-lines files instead of a
topic.  ``--execution_date`` is accepted for scheduler compatibility and not
used.  The session comes from ``spark-submit``; ``--spark_master`` only applies
when the script builds its own.
"""

from __future__ import annotations

import argparse
import logging

from candela.session import get_session
from candela.streaming.pipeline import PipelineConfig, run_pipeline


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Stream bar messages into clean / failed feature tables")
    p.add_argument("--kafka_servers", default=None, help="bootstrap servers (kafka source)")
    p.add_argument("--kafka_topic", default=None, help="topic to subscribe to (kafka source)")
    p.add_argument("--output_path", required=True, help="root of clean_data / failed_data")
    p.add_argument("--checkpoint_path", required=True, help="streaming checkpoint folder")
    p.add_argument("--execution_date", default=None, help="accepted, not used")
    p.add_argument("--spark_master", default="", help="master URL when not under spark-submit")
    p.add_argument("--timeout_minutes", type=float, default=10.0)
    p.add_argument("--trigger_seconds", type=int, default=30)
    p.add_argument("--available_now", action="store_true", help="drain what is there, then stop")
    p.add_argument("--source_format", default="kafka", choices=["kafka", "text", "landing", "topic"])
    p.add_argument("--source_path", default=None, help="folder of JSON-lines files (text) of one CSV file per symbol (landing), or of partition logs (topic)")
    p.add_argument("--max_files", type=int, default=None, help="files a batch reads at most (landing source)")
    p.add_argument("--sink_format", default="parquet", choices=["parquet", "delta"])
    p.add_argument("--history", action="store_true", help="continue windows across batches")
    p.add_argument("--no_dedupe", action="store_true", help="keep re-delivered (symbol, date) copies")
    p.add_argument("--quarantine", default="after", choices=["after", "before"],
                   help="check bars after the windows, or set failed bars aside before them")
    p.add_argument("--rollups", action="store_true", help="keep weekly and monthly rollups up to date")
    p.add_argument("--keep_raw", action="store_true", help="keep the message text of failed rows")
    p.add_argument("--chunk_rows", type=int, default=None,
                   help="cut longer series of a batch into chunks of so many bars")
    p.add_argument("--volume_threshold", type=float, default=1_000_000.0)
    return p.parse_args(argv)


def config_from_args(args: argparse.Namespace) -> PipelineConfig:
    options: dict[str, str] = {}
    if args.source_format == "kafka":
        if not (args.kafka_servers and args.kafka_topic):
            raise SystemExit("--kafka_servers and --kafka_topic are required for the kafka source")
        options = {"kafka.bootstrap.servers": args.kafka_servers, "subscribe": args.kafka_topic}
    elif not args.source_path:
        raise SystemExit("--source_path is required for the text, landing and topic sources")
    return PipelineConfig(
        output_path=args.output_path, checkpoint_path=args.checkpoint_path,
        source_format=args.source_format, source_path=args.source_path, source_options=options,
        sink_format=args.sink_format, trigger_seconds=args.trigger_seconds,
        available_now=args.available_now, timeout_minutes=args.timeout_minutes,
        quarantine=args.quarantine, keep_raw=args.keep_raw, rollups=args.rollups, max_files=args.max_files, chunk_rows=args.chunk_rows,
        history=args.history, dedupe=not args.no_dedupe, volume_threshold=args.volume_threshold,
    )


def main(argv: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    args = parse_args(argv)
    cfg = config_from_args(args)
    spark = get_session(args.spark_master or None)
    spark.conf.set("spark.sql.streaming.stopGracefullyOnShutdown", "true")
    try:
        run_pipeline(spark, cfg)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
