"""Script for spark-submit; see `eventfares.plans.live`."""

from eventfares.plans.live import main

if __name__ == "__main__":
    main()
