"""``python -m usagelens ...`` runs the combined job (see usagelens.plans.run_all)."""

from usagelens.plans.run_all import main

if __name__ == "__main__":
    main()
