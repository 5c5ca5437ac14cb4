"""DataFrame-in, DataFrame-out operators; none of them starts a job."""
