"""Jobs for ``spark-submit`` or ``python -m evenkeel.jobs.<name>``."""
