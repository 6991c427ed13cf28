"""DataFrame operators shared by the jobs in ``tonearm.plans`` and ``tonearm.streaming``."""
