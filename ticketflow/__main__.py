"""``python -m ticketflow --as-of YYYY-MM-DD --out PATH ...`` runs the daily refresh job."""

from .job import main

if __name__ == "__main__":
    main()
