"""Command-line jobs: ``python -m jobs.<name> --help``, or ``spark-submit`` with the repository
root on ``PYTHONPATH``."""
