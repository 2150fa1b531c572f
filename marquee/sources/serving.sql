-- Tables of the serving store, to be created once by whoever runs it.
-- The types hold every value that is published; key and index serve the two reports.
create table if not exists actors_actress_kpis (
    nconst varchar(32) not null,
    role varchar(32) not null,
    name text,
    average_rating decimal(14, 5),
    total_run_time_minutes bigint,
    total_titles_as_principal bigint,
    primary key (nconst, role)
);

create index if not exists actors_actress_kpis_by_role on actors_actress_kpis (role);

create table if not exists etl_pipeline_status (
    stage varchar(64) not null,
    table_name varchar(64) not null,
    date date not null,
    status varchar(32) not null,
    primary key (stage, table_name, date, status)
);
