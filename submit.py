"""Script entry point for ``spark-submit`` (same commands as ``python -m encore``)."""

import sys

from encore.__main__ import main

if __name__ == "__main__":
    main(sys.argv[1:])
