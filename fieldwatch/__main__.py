"""``python -m fieldwatch --mode {anomaly,metrics,all,daily,train}``."""

import argparse

from fieldwatch.streaming.jobs import BATCH_MODES, MODES, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="fieldwatch", description="Run the jobs")
    parser.add_argument("--mode", choices=[*MODES, *BATCH_MODES], default="all")
    run(parser.parse_args().mode)


if __name__ == "__main__":
    main()
