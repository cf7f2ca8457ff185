"""Entry for spark-submit; see costflow/jobs.py."""

from costflow.jobs import main

if __name__ == "__main__":
    main()
