"""Migration plans and their execution: targets, status plan, convert/register, views, report."""
