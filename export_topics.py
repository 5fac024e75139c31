"""Script for ``spark-submit``: export topics from landed pages (see ``--help``)."""

from gaugeframe.__main__ import main

if __name__ == "__main__":
    main()
