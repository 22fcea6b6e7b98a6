"""Entry file for ``spark-submit job.py <job>``; ship the package with ``--py-files``."""

from tidemark.__main__ import main

if __name__ == "__main__":
    main()
