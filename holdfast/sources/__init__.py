"""Feed schemas, readers, sinks and the binding of domain feeds to warehouse tables."""
