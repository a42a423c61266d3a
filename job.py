"""Entry script for spark-submit; see shelfmark/cli.py."""

from shelfmark.cli import main

if __name__ == "__main__":
    main()
