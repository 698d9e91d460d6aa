"""spark-submit entry point, see README."""

from marketlens.jobs import main

if __name__ == "__main__":
    main()
