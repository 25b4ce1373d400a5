"""Jobs: staging, marts, insights, reports, fleet."""
