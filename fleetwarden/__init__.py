"""Analytics over a fleet of database servers, as DataFrame-to-DataFrame operators."""
