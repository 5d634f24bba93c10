"""DataFrame-to-DataFrame steps. None of them runs a job unless its name says so."""
