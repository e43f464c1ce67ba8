"""Entry point for spark-submit."""

from shelfline.cli import main

if __name__ == "__main__":
    main()
