"""Launcher for spark-submit: the streaming job with the reference's options.

    spark-submit --py-files trailmark.zip run_job.py --inputPath=/data/clicks --outputPath=/data/results \
        --checkpointPath=/data/state --trigger="1 minute" --errorsSink=parquet_updates --allTime
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trailmark.cli import main  # noqa: E402

if __name__ == "__main__":
    main()
